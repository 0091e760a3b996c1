"""The pipeline against the stages written anew by brute force, on a corpus with nulls, copies and shared passages."""

import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("tidemark.llm")
pipeline = pytest.importorskip("corpus_pipeline")

from test_operators import brute_components, brute_hits, brute_lines, brute_llr, brute_print, brute_quality, library  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, td_n_dropped string, td_gone string, td_key string"


def corpus():
    r = random.Random(3)
    words = [f"w{i}" for i in range(200)] + ["the", "of", "and"] * 40
    prose = lambda n: " ".join(r.choices(words, k=n))
    passage = prose(20)
    out = [(i, f"Read more on this site\n{prose(r.randint(8, 60))}\n{prose(12)}") for i in range(40)]
    out += [(40, out[3][1]), (41, out[3][1]), (42, out[5][1] + " end"), (43, f"{prose(30)} {passage} {prose(5)}"), (44, passage), (45, prose(500) + " " + passage), (46, None), (47, ""), (48, "few words"), (49, "spam " * 60), (None, prose(30)), (None, None)]
    out += [(50 + i, prose(4000)) for i in range(2)] + [(60 + i, " ".join(f"odd{r.random()}" for _ in range(25))) for i in range(5)]
    rows = [(i, t, "en", None if k % 9 == 0 else f"s{k % 2}", None if t is None else len(t), "a", "b", "c") for k, (i, t) in enumerate(out)]
    return [*rows, rows[7], rows[7]], [(1, passage), (2, "unseen words"), (None, prose(15)), (3, None)]


def write(spark, folder, rows, items):
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i < 60), 0) for i in range(64)] + [(None, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_run_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    folder = f"file://{tmp_path}"
    write(spark, folder, rows, items)
    llr = brute_llr([(r[0], r[1]) for r in rows], set(range(60)))
    want = [[r for r, x in zip(rows, llr, strict=True) if not brute_quality(r[1])[5] and x >= -0.2]]
    cut = brute_lines([(r[1], r[3]) for r in want[-1]], 0.08)
    want.append([(r[0], t, *r[2:4], len(t) if n else r[4], *r[5:]) for r, (_, n, t) in zip(want[-1], cut, strict=True)])
    ids = [r[0] for r in want[-1]]
    roots = brute_components(ids, [brute_print(r[1]) for r in want[-1]])
    gone = {i for i, c in zip(ids, roots, strict=True) if i != c and i is not None}
    want.append([r for r in want[-1] if r[0] not in gone])
    want.append([r for r in want[-1] if not brute_hits(items, r[1])[4]])
    assert len({len(w) for w in [rows, *want]}) == 4 and sum(n for _, n, _ in cut)  # each stage does something
    before, text = spark.read.parquet(f"{folder}/documents.parquet"), lambda rows: sorted(map(str, rows))
    for (name, step), expected in zip(pipeline.STAGES, want, strict=False):
        after = step(spark, before, folder).cache()
        assert after.columns == before.columns and text(tuple(r) for r in after.collect()) == text(expected), name
        before = after
    t = library("word_bpe_49k.json")
    final = []
    for r in want[-1]:
        ids = t.encode(r[1], add_special_tokens=False).ids
        final.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    last = pipeline.run(spark, folder)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and text(tuple(r) for r in last.collect()) == text(final)


def test_run_over_empty_tables(spark, tmp_path):
    folder = f"file://{tmp_path}"
    write(spark, folder, [], [])
    assert pipeline.run(spark, folder).collect() == []
