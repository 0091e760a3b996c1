"""Each operator against a brute-force version on a small fixture: nulls in any column, empty and very long texts,
ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import html
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

pytest.importorskip("tidemark.llm")
P = pytest.importorskip("public_tokenizers")

from tidemark.llm import forced_bpe, fragments, html_extract, lattice_lm, license_index, line_dedup, quality_llr, simhash_ball, token_count, token_store, winnow  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, fp string, row long, word string, td_text string, td_n_lines string, td_keys string, td_key string, TD_SITE string, td_spans string, td_starts string, td_gone string, kept string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
random.seed(5)
SOUP = ["".join(random.choice(" \n\t'sab1É.%\x1ćİ<>") for _ in range(random.randint(1, 50))) for _ in range(40)]
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
BOILER = "Subscribe to our newsletter today"
TEXTS = [
    None, "", " ", "\n\n", "word", "Two words", "a b c", "a b c", "x<|endoftext|> y <|startoftext|>Z", "naïve CAFÉ ﬁ ß 中文 \xa0　",
    "All rights reserved. Licensed under the Apache License, Version 2.0", "cc by cc by CC-BY nc 4.0", "THE GNU GENERAL PUBLIC LICENSE, version 3!", "by cc", "public license",
    "intro " + PASSAGE + " outro", "Only " + PASSAGE.upper()[4:] + " tail " * 300, "short item", "x short ITEM, y", "the " * 40,
    *[f"{BOILER}\nBody {i} has its own words like w{i} and v{i * 7} in a row\n\n  {BOILER} \r\nend {i}" for i in range(12)],
    "long " + " ".join(f"w{i % 977}" for i in range(30000)), "z" * 20000, "#" * 30 + "|$%&<> junk", *SOUP,
]
SITES = ("s0", "s1", "HTTPS://me@S1:80/p?q", "ftp://s0")
ROWS = [(i if i != 9 else None, t, "en", None if i % 11 == 0 else SITES[i % 4], len(t or ""), 1, "f", 7, "w", None, *"abcdefgh") for i, t in enumerate(TEXTS)]
ROWS.append(ROWS[20])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path(name))


def test_token_counts(docs, none):
    t = library("byte_bpe_50k.json")
    n = [len(t.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS]
    same(rows(token_count.count_tokens(docs, P.path("byte_bpe_50k.json"))), [(r[0], len((r[1] or "").encode()), x, x > 512) for r, x in zip(ROWS, n, strict=True)])
    assert rows(token_count.count_tokens(none, P.path("byte_bpe_50k.json"))) == []
    assert token_count.count_tokens(docs.limit(3), P.path("piece_bpe_32k.model")).count() == 3


def test_fragments_are_safe_on_odd_texts():
    t, f = library("byte_bpe_50k.json"), fragments.FragmentEncoder(P.path("byte_bpe_50k.json"))
    texts = ["".join(random.choice(" \n\t'sab1é.%\x1c<|endoftext|>\x85 ") for _ in range(random.randint(0, 40))) for _ in range(2000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in f.encode(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert list(fragments.balanced(["aa", "b", "cccc", "d"], 3)) == [["aa", "b"], ["cccc"], ["d"]]


def test_token_store(spark, docs, none, tmp_path, monkeypatch):
    t, path = library("byte_bpe_50k.json"), f"file://{tmp_path}/store"
    token_store.write_tokens(docs, path, P.path("byte_bpe_50k.json"), 2)
    got = sorted(rows(token_store.read_tokens(spark, path)), key=lambda r: r[1])
    ids = sorted(((r[0] is not None, r[0] or 0, zlib.crc32(np.array(x, "<u4").tobytes()), len(x)) for r in ROWS for x in [[*t.encode(r[1] or "", add_special_tokens=False).ids, 2]]))
    assert [(r[0], r[2], r[3]) for r in got] == [(i if known else None, n, crc) for known, i, crc, n in ids]
    assert [r[1] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]
    some = rows(token_store.read_tokens(spark, path, [4, 33]))
    assert some == [r for r in rows(token_store.read_tokens(spark, path)) if r[0] in (4, 33)]
    monkeypatch.setattr(token_store, "RANGES", 2)
    assert rows(token_store.read_tokens(spark, path, [1, 2, 30, 31, 60, 999])) == [r for r in rows(token_store.read_tokens(spark, path)) if r[0] in (1, 2, 30, 31, 60)]
    assert rows(token_store.read_tokens(spark, path, [])) == []
    plan = token_store.read_tokens(spark, path, [4])._jdf.queryExecution().toString()
    assert "LessThanOrEqual(first,4)" in plan and "GreaterThanOrEqual(last,4)" in plan  # reaches the scan
    assert rows(token_store.store_and_read(none, P.path("byte_bpe_50k.json"), 2)) == []


def test_forced_bpe(docs, none):
    t = library("word_bpe_49k.json")

    def want(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    same(rows(forced_bpe.encode_documents(docs, P.path("word_bpe_49k.json"))), [(r[0], *want(r[1])) for r in ROWS])
    assert rows(forced_bpe.encode_documents(none, P.path("word_bpe_49k.json"))) == []
    full = forced_bpe.encode_documents(docs.where("doc_id = 8"), P.path("word_bpe_49k.json"), digests=False).first()
    assert full["ids"] == t.encode(TEXTS[8], add_special_tokens=False).ids
    model = forced_bpe.ForcedBPE(P.path("word_bpe_49k.json"))
    assert any(len(model.cut(w)) > 1 for w in ("qzxjk", "wqxzj")) and "".join(model.cut("qzxjk")) == "qzxjk"
    odd = ["İ. aİ, É,é", "it's. it'll,b 1.5a,", "x.<|startoftext|>y<|endoftext|>.", "näive, ſ, ǆ. \x85 x.."]
    odd += ["".join(random.choice(" \n'sab1éİ.,<|endoftext|>\x85") for _ in range(random.randint(0, 40))) for _ in range(2000)]
    for _ in range(2):  # unknown pieces, then kept ones
        assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(odd)] == [e.ids for e in t.encode_batch(odd, add_special_tokens=False)]


def test_forced_bpe_refuses_a_file_with_unknown_bytes(tmp_path):
    import json

    spec = json.loads(library("word_bpe_49k.json").to_str())
    spec["model"]["vocab"] = {t: i for t, i in spec["model"]["vocab"].items() if "a" not in t}
    spec["model"]["merges"] = [m for m in spec["model"]["merges"] if "a" not in "".join(m)]
    spec["model"]["unk_token"] = "<|endoftext|>"
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="has no token"):
        forced_bpe.ForcedBPE(str(tmp_path / "t.json"))


def test_html(spark):
    page = '<html><head><title>T</title></head><nav><a href=x>Home</a></nav><article class="post"><h1>Head &amp; line</h1><p>First <b>bold</b>\n text<br>more<p>Second<div class="comments"><p>Nice!</p></div></article><aside>Ad</aside><footer>(c)</footer>'
    pages = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", None), (None, "u", "<script>if (a<b) {}", "x"), (5, "u", "plain text " * 30, "x"), (1, "u", page, "x"), (6, "u", "<p>" * 5000 + "&am &lt;p&gt;" + "word " * 50, None)]
    got = rows(html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string")))
    text = "Head & line\n\nFirst bold text more\n\nSecond"
    want = [(1, "u", text), (1, "u", text), (2, None, ""), (3, "u", ""), (None, "u", ""), (5, "u", ("plain text " * 30).strip()), (6, "u", "&am <p>" + ("word " * 50).strip())]
    same(got, [(*w, len(w[2])) for w in want])
    assert rows(html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"))) == []


def test_html_on_pages_of_the_test_data(spark):
    table = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    for page in table["html"]:
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert html_extract.main_text(page) == "\n\n".join(filter(None, blocks))


WORDY = " ".join(f"word{i}" for i in range(80))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article class='post social-share-enabled'><p>{WORDY}</p><p>Two words</article>", [WORDY, "Two words"]),
        (f"<div class='main-content with-sidebar'><p>{WORDY}</p></div><div class=sidebar><a>More</a></div>", [WORDY]),
        (f"<article class=sponsored><h1>Head</h1><p>{WORDY}</article><footer>{WORDY}</footer>", ["Head", WORDY]),
        (f"<main><div class=menu>Menu words here</div><h1>Head</h1><p>{WORDY}</main>", ["Head", WORDY]),
        (f"<ul><li><a>Home</a><li><a>News</a></ul><h1>Head of it</h1><p>{WORDY}</p><p>{WORDY}</p><p><a>Terms</a> <a>Legal</a></p>", ["Head of it", WORDY, WORDY]),  # plain containers
        (f"<table><tr><td><a>Home</a><td><a>News</a></table><table><tr><td>{WORDY}<tr><td>{WORDY}</table>", [WORDY, WORDY]),
        (f"<article><p>{WORDY}<ul><li><a>One link</a><li><a>Another</a></ul><p>End</article><div class=comments><p>{WORDY}</div>", [WORDY, "One link", "Another", "End"]),
        (f"<form><nav><a>Home</a></nav><article><p>{WORDY}</p><p>{WORDY}</article></form>", [WORDY, WORDY]),
        (f"<p title=\"a > b\">{WORDY} x<!-- <p>no --> &lt;b&gt; 1 < 2 &#99999999999999999999; <button>Buy</button>end<p hidden>none<div style='display: none'>none</div>", [f"{WORDY} x <b> 1 < 2 � end"]),
        (f"<footer>{WORDY}</footer>", []), (f"<nav>{WORDY}</nav><div class=comments>{WORDY}</div>", []),
    ],
)
def test_html_by_structure(page, want):
    assert html_extract.main_text(page) == "\n\n".join(want)


def test_html_tree_looks_at_neighbours():
    def used(tree):
        return {html_extract.FEATURES[tree[0]]} | used(tree[2]) | used(tree[3]) if isinstance(tree, tuple) else set()

    tree = html_extract.default_tree()
    assert html_extract.FEATURES[tree[0]] != "in_frame" and used(tree) & {"words_before", "words_after"} and used(tree) & {"links_before", "links_after"}
    assert all(html_extract.classify(tree, r[:-1]) == r[-1] for r in html_extract.labelled())


@pytest.mark.parametrize("part", ["<a ", "<script ", "<script>", "</table>", "<div></table>", "<a b=\"'>", "<a b='", "= <", "<!--", "<!x ", "&#9", "&#" + "9" * 50, "<td></div>", "<button>", "<div class=\" ", "<li>x", "<"])
def test_html_takes_time_in_proportion(part):
    """A page of one megabyte that an unfortunate search would go through again and again."""
    began = time.process_time()
    html_extract.main_text(part * (1_000_000 // len(part)))
    html_extract.main_text("<p " + part * (1_000_000 // len(part)))
    assert time.process_time() - began < 6


def brute_lines(rows, ratio):
    """n_lines, n_dropped and text of each (text, source)."""
    site = lambda x: {"HTTPS://me@S1:80/p?q": "s1", "ftp://s0": "s0", None: ""}.get(x, x)
    strip = lambda x: x.strip(" \t\r")
    pages, held = Counter(site(s) for _, s in rows), Counter()
    for t, s in rows:
        held.update({(site(s), strip(x)) for x in (t or "").split("\n") if strip(x)})
    over = {k for k, n in held.items() if pages[k[0]] * ratio >= 1 and n > pages[k[0]] * ratio}
    out = []
    for t, s in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if (site(s), strip(x)) not in over]
        out.append((0, 0, None) if t is None else (len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_line_dedup(spark, docs, none, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)  # -1: the flagged lines are over any limit
    try:
        whole = line_dedup.drop_boilerplate(docs, ratio=0.1, n_lines="n_lines", n_dropped="n_dropped")
        assert whole.columns == [*docs.columns, "n_lines", "n_dropped"]
        got = rows(whole.select("doc_id", "n_lines", "n_dropped", "text"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    c = duckdb.connect()
    c.register("documents", pd.DataFrame([(r[0], r[1], r[3]) for r in ROWS], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    same(got, c.execute(line_dedup.oracle_sql(0.1)).fetchall())
    same(got, [(r[0], *x) for r, x in zip(ROWS, brute_lines([(r[1], r[3]) for r in ROWS], 0.1), strict=True)])
    assert [r[0] for r in got if BOILER in (r[3] or "")] == [22]  # of the site '', which has few pages
    assert line_dedup.drop_boilerplate(docs).columns == [*docs.columns, "td_n_lines_", "td_n_dropped"]
    assert rows(line_dedup.drop_boilerplate(none)) == []


def test_a_hot_site_is_split(spark):
    """Where the flagged lines are not broadcast, adaptive execution splits a site with most of the pages."""
    docs = spark.range(40_000).selectExpr("id AS doc_id", "concat('menu', chr(10), 'line ', id, ' ', repeat(md5(cast(id AS string)), 8)) AS text", "CASE WHEN id % 10 < 9 THEN 'hot' ELSE concat('s', id % 50) END AS source").repartition(16).cache()
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = line_dedup.drop_boilerplate(docs)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan.replace("SortMergeJoin (skew=true)", "SortMergeJoin(skew=true)")
    assert df.where("td_n_dropped = 1").count() == 40_000


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), sum(x in "#*$%&|<>" for x in text or ""), len(lines) - len(set(lines)), len(inside), n < 10 or 100 * len(inside) > 20 * n


def brute_llr(docs, trusted):
    """Mean log ratio by plain counting of hashed words and pairs."""
    mask, mix = (1 << 64) - 1, int(quality_llr._MIX)

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        return [x >> 48 for x in h] + [(((a * mix & mask) ^ b) * mix & mask) >> 48 for a, b in zip(h, h[1:], strict=False)]

    raw, target = Counter(), Counter()
    for i, t in docs:
        raw.update(grams(t))
        target.update(grams(t) if i in trusted else ())
    n, m, size = sum(raw.values()), sum(target.values()), 1 << 16
    llr = lambda g: math.log((target[g] + 1) / (m + size)) - math.log((raw[g] + 1) / (n + size))
    return [sum(map(llr, g)) / len(g) if (g := grams(t)) else 0.0 for _, t in docs]


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 40)] + [(4, 0, 0), (None, 1, 0), (5, None, 0), (999, 1, 0), (7, 1, None)], "doc_id long, quality int, toxic int")
    trusted = {i for i in range(40) if i % 3 > 0} - {4}
    llr = brute_llr([(r[0], r[1]) for r in ROWS], trusted)
    got = rows(quality_llr.assess(docs, labels, threshold=-0.2))
    same([r[:7] for r in got], [(r[0], *brute_quality(r[1])) for r in ROWS])
    assert np.allclose(sorted(r[8] for r in got), sorted(llr))
    kept = [r[0] for r, x in zip(ROWS, llr, strict=True) if not brute_quality(r[1])[5] and x >= -0.2]
    same([r[0] for r in got if r[7]], kept)
    good = quality_llr.keep_good(docs, labels, threshold=-0.2)
    assert good.columns == docs.columns
    same([r[0] for r in good.collect()], kept)
    assert rows(quality_llr.assess(none, labels)) == [] and all(r[8] == 0 for r in rows(quality_llr.assess(docs, labels.limit(0))))


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((ids[k] for k in range(len(ids)) if group[k] == g and ids[k] is not None), default=None) for g in group]


def test_near_duplicates(spark, docs, none):
    prints = [brute_print(r[1]) for r in ROWS]
    want = list(zip([r[0] for r in ROWS], [f"{x:016x}" for x in prints], brute_components([r[0] for r in ROWS], prints), strict=True))
    same(rows(simhash_ball.near_duplicates(docs)), want)
    assert rows(simhash_ball.near_duplicates(none)) == []
    kept = simhash_ball.keep_one(docs)
    assert kept.columns == docs.columns
    same([r[0] for r in kept.collect()], [w[0] for w in want if w[0] is None or w[0] == w[2]])


@pytest.mark.parametrize("run", [64, 3, 1])
def test_links_of_dense_fingerprints(spark, run):
    """Chains and balls of near fingerprints, by pairs and by the exact ball."""
    centre = [random.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 5))) for c in centre for _ in range(60)} | {random.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    from tidemark.llm.components import components

    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(simhash_ball.links(table, run)).collect()}
    want = brute_components(list(range(len(prints))), prints)
    groups: dict = {}
    for x, w in zip(prints, want, strict=True):
        groups.setdefault(w, set()).add(found.get(x, x))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_many_equal_rows_and_hot_groups(spark, monkeypatch):
    """A third of all rows are one text, another third near copies of it; hot keys and others are joined alike."""
    from tidemark.llm import common

    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)] * 3000 + [" ".join(words[: 399 - i % 3]) for i in range(3000)] + [f"other {i} " + " ".join(random.choices(words, k=30)) for i in range(300)]
    prints = [brute_print(t) for t in texts[:1] + texts[3000:3003] + texts[6000:]]
    want = dict(zip([0, 3000, 3001, 3002, *range(6000, 6300)], brute_components([0, 3000, 3001, 3002, *range(6000, 6300)], prints), strict=True))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for hot in (1 << 16, 4):
        monkeypatch.setattr(common, "HOT", hot)
        got = {r["doc_id"]: r["component_id"] for r in simhash_ball.near_duplicates(table).collect()}
        assert all(got[i] == want[0] for i in range(3000)) and all(got[i] == want[3000 + i % 3] for i in range(3000, 6000)) and all(got[i] == want[i] for i in range(6000, 6300))


def test_a_hot_key_is_joined_without_a_shuffle_of_its_rows(spark, monkeypatch):
    from tidemark.llm import common

    left = spark.range(4000).selectExpr("CASE WHEN id < 3000 THEN 7 ELSE id END AS a", "id AS b")
    right = common.stage(left.groupBy("a").count().selectExpr("a", "a * 2 AS m", "`count` AS rows"))
    monkeypatch.setattr(common, "HOT", 100)
    joined = common.spread_join(left, right, "a", "rows", 4000)
    assert joined.where("m = 2 * a").count() == 4000 and joined.where("a = 7").count() == 3000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = common.spread_join(left, right, "a", "rows", 4000)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" in plan


def test_components_of_chains_and_stars(spark):
    from tidemark.llm.components import components

    edges = [(i, i + 1) for i in range(100, 300)] + [(5, i) for i in range(1000, 1400)] + [(7, 7), (None, 1), (2, 9), (9, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(16)).collect()}
    assert got == {i: 100 for i in range(101, 301)} | {i: 5 for i in range(1000, 1400)} | {9: 2}


def test_small_tables_are_staged_in_few_files(spark, monkeypatch):
    """with many shuffle partitions, rounds over some thousand links were written in a file for each partition."""
    from tidemark.llm import common, components

    files: dict[str, int] = {}

    def counted(df, name="stage", *args, **options):
        out = common.stage(df, name, *args, **options)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(components, "stage", counted)
    monkeypatch.setattr(simhash_ball, "stage", counted)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)] * 200 + [" ".join(words[: 399 - i % 200]) for i in range(400)] + [f"other {i} " + " ".join(random.choices(words, k=30)) for i in range(300)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 40)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(simhash_ball.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), run=2).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    prints = [brute_print(t) for t in texts]
    want = brute_components(list(range(len(texts))), prints)
    assert [tuple(r) for r in got] == [(i, f"{p:016x}", w) for i, (p, w) in enumerate(zip(prints, want, strict=True))]
    assert set(files) == {"prints", "groups", "pairs", "links", "least", "stars", "rooted", "lowest", "named"}
    assert max(n for name, n in files.items() if name != "links") <= spark.sparkContext.defaultParallelism + 1
    assert files["links"] <= 3 * spark.sparkContext.defaultParallelism


def test_more_rows_are_staged_in_more_files(spark, monkeypatch):
    from tidemark.llm import common

    monkeypatch.setattr(common, "FILE_ROWS", 100)
    table = common.stage(spark.range(0, 1000, 1, 40).toDF("a"), rows=1000)
    assert len(table.inputFiles()) == 10 and table.count() == 1000


def test_licenses(spark, docs, none):
    c = duckdb.connect()
    c.register("documents", pd.DataFrame([(r[0], r[1]) for r in ROWS], columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    same(rows(license_index.scan(docs)), c.execute(license_index.oracle_sql()).fetchall())
    got = {r["doc_id"]: r for r in license_index.scan(docs).collect()}
    assert (got[10]["n_base"], got[10]["first_word"], got[10]["labels"], got[10]["score"]) == (1, 0, "apache-2.0,reserved", 1.0)
    assert (got[11]["n_base"], got[11]["last_word"], got[11]["labels"]) == (3, 4, "cc-by,cc-by-nc") and got[13]["first_word"] is None
    assert rows(license_index.scan(none)) == []


def test_whole_licence_notices(spark):
    """Each notice in full, in its middle only, with its key phrase broken, and many times over."""
    from tidemark.llm.notices import NOTICES

    texts = []
    for label, notice, key in NOTICES:
        words = notice.split()
        texts += [(notice, label), (f"Copyright (c) 2020 Someone\n\n{notice.upper()}\n" + "code here " * 50, label), (" ".join(words[len(words) // 6 :]), None), (f"{key} " * 300, None), (notice.replace(" the ", " a ").replace(" or ", " nor "), None), (" ".join(reversed(words)), None)]
    table = [(i, t) for i, (t, _) in enumerate(texts)]
    c = duckdb.connect()
    c.register("documents", pd.DataFrame(table, columns=["doc_id", "text"]))
    got = rows(license_index.scan(spark.createDataFrame(table, "doc_id long, text string").repartition(4)))
    want = sorted(c.execute(license_index.oracle_sql()).fetchall())
    assert [r[:-1] for r in got] == [r[:-1] for r in want] and np.allclose([r[-1] for r in got], [r[-1] for r in want])
    assert all(label in r[6].split(",") and r[7] == 1.0 for r, (_, label) in zip(got, texts, strict=True) if label)


def brute_hits(items, text):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, found = split(text), set(), set()
    for i, t in items:
        w = split(t)
        m = min(13, len(w))
        windows = {tuple(w[s : s + m]) for s in range(len(w) - m + 1)} if m else set()
        for p in range(len(words) - m + 1):
            if tuple(words[p : p + m]) in windows:
                hit.update(range(p, p + m))
                found.update([] if i is None else [str(i)])
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_contamination(spark, docs, none, limit):
    items = [(3, PASSAGE), (20, "before " + PASSAGE[:70] + " other"), (4, "short item"), (5, None), (6, "?!"), (None, "Body 3 has its own words"), (4, "public license"), (11, "the the the the the the the the the the the the the the"), (12, TEXTS[32][9000:9400])]
    benchmark = spark.createDataFrame([(*x, "q") for x in items], "item_id long, text string, doc_id string")
    want = [(r[0], *brute_hits(items, r[1])) for r in ROWS]
    got = rows(winnow.contamination(docs, benchmark, limit))
    same(got, want)
    assert next(r for r in got if r[0] == 32)[2] > 500  # the very long text, which repeats
    clean = winnow.drop_contaminated(docs, benchmark, limit)
    assert clean.columns == docs.columns
    same([r[0] for r in clean.collect()], [w[0] for w in want if not w[5]])
    assert rows(winnow.contamination(none, benchmark, limit)) == [] and not any(r[5] for r in rows(winnow.contamination(docs, benchmark.limit(0))))


def test_contamination_by_long_items(spark, monkeypatch):
    """Items of many pieces in many blocks: spans across a piece's end are found, by fingerprints and in one block alike."""
    monkeypatch.setattr(winnow, "PIECE_WORDS", 40)
    words = [random.choice("abcdefghijklmnop") + str(random.randrange(400)) for _ in range(1500)]
    items = [(i, " ".join(words[i * 300 : i * 300 + 320])) for i in range(5)]
    texts = [" ".join([*words[i * 29 : i * 29 + n], "and", "then", *words[:12], "end"]) for i in range(50) for n in (12, 13, 45)]
    docs, benchmark = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = [(i, *brute_hits(items, t)) for i, t in enumerate(texts)]
    for limit in (1 << 20, 700):
        same(rows(winnow.contamination(docs, benchmark, limit)), want)


def test_contamination_takes_time_in_proportion():
    block = winnow.Block([("x", [b"the"] * 4000), ("y", [b"the", b"a"] * 2000)])
    began = time.process_time()
    spans, items = block.find([b"the"] * 100_000)
    assert time.process_time() - began < 2 and winnow.merged(spans) == [(0, 100_000)] and items == {"x"}


def test_winnowing_guarantee():
    g = np.array([random.getrandbits(5) for _ in range(3000)], np.uint64)
    for width in (1, 4, 9):
        at = winnow.winnow(g, width)
        assert (np.diff(at) <= width).all()
        for i in range(0, 2900, 37):
            low = min(g[i : i + width])
            assert max(j for j in range(i, i + width) if g[j] == low) in at


def brute_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_lattice(word, weight, longest):
    """Log probability of a word and the expected count of each piece, by a plain forward and backward pass in logs.

    ``weight``: log weight of a piece, or of a character that has none, or None."""
    s = lattice_lm.MARK + word
    edges = [(i, j, w) for i in range(len(s)) for j in range(i + 1, min(len(s), i + longest) + 1) if (w := weight(s[i:j])) is not None]
    add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b)
    to, back = [0.0] + [-math.inf] * len(s), [-math.inf] * len(s) + [0.0]
    for i, j, w in edges:
        to[j] = add(to[j], to[i] + w)
    for i, j, w in reversed(edges):
        back[i] = add(back[i], back[j] + w)
    expected = Counter()
    for i, j, w in edges:
        expected[s[i:j]] += math.exp(to[i] + w + back[j] - to[-1])
    return to[-1], expected


@pytest.mark.parametrize("frequent", [1 << 18, 20])
def test_scores(spark, docs, none, frequent):
    """Against plain counting and a plain re-estimation, both written anew here."""
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in ROWS]
    tokens = [[*brute_words(r[1]), " "] for r in ROWS]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    rest = Counter(w for t, h in zip(tokens, held, strict=True) if h for w in t)
    n, v = sum(c.values()), len(c)
    path = P.path("piece_bpe_32k.model")
    ids, by_byte, start = lattice_lm.vocabulary(path)
    longest, start = max(map(len, ids)), np.exp(start)
    end = 1 / (len(start) + 1)
    prob, tried = start * (1 - end), []
    spell = lambda ch: [by_byte[b] for b in ch.encode()]
    own = final = None

    def weight_by(prob):
        return lambda p: math.log(prob[ids[p]]) if p in ids else sum(math.log(prob[i]) for i in spell(p)) if len(p) == 1 else None

    every = {w: plain_lattice(w, weight_by(prob), longest) for w in {*c, *rest} - {" "}}
    own = {w: x[0] for w, x in every.items()} | {" ": math.log(end)}
    before = (prob, end)
    for _ in range(lattice_lm.ROUNDS):
        if tried:
            every = {w: plain_lattice(w, weight_by(prob), longest) for w in {*c, *rest} - {" "}}
        tried.append((sum(k * every[w][0] for w, k in rest.items() if w != " ") + rest[" "] * math.log(end)) / sum(rest.values()))
        if len(tried) > 1 and tried[-1] < tried[-2] + lattice_lm.TOLERANCE:
            final = before if tried[-2] > tried[-1] else (prob, end)
            break
        x = lattice_lm.PRIOR * start
        for w, k in c.items():
            for p, y in (every[w][1].items() if w != " " else ()):
                for i in [ids[p]] if p in ids else spell(p):
                    x[i] += k * y
        total = sum(x) + c[" "] + 1
        before, prob, end = (prob, end), x / total, (c[" "] + 1) / total
    prob, end = final or (prob, end)
    fitted = {w: plain_lattice(w, weight_by(prob), longest)[0] for w in every} | {" ": math.log(end)}
    log10 = lambda table, t: sum(table[w] for w in t) / math.log(10)
    want = sorted(((r[0] is not None, r[0] or 0, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), log10(fitted, t), log10(own, t)) for r, h, t in zip(ROWS, held, tokens, strict=True)))
    got = sorted((x[0] is not None, x[0] or 0, *x[1:]) for x in map(tuple, lattice_lm.score_texts(docs, path, frequent=frequent).collect()))
    assert [x[:6] for x in got] == [x[:6] for x in want]
    assert np.allclose([x[6:] for x in got], [x[6:] for x in want], rtol=1e-9)
    assert rows(lattice_lm.score_texts(none, path)) == []


def test_expected_counts_over_all_segmentations():
    """Every segmentation of a short word written out."""
    walk = lattice_lm.Lattice(P.path("piece_bpe_32k.model"))

    def every(s):
        if not s:
            yield 1.0, ()
        for j in range(1, len(s) + 1):
            if s[:j] in walk.ids or j == 1:
                w, ids = (math.exp(walk.lp[walk.ids[s[:j]]]), (walk.ids[s[:j]],)) if s[:j] in walk.ids else (math.exp(walk.spelled(s[0])[0]), tuple(walk.spelled(s[0])[1]))
                for p, more in every(s[j:]):
                    yield w * p, ids + more

    for word in ("the", "reading", "naïve", "中x", "aaaaa", ""):
        paths, want, got = list(every(lattice_lm.MARK + word)), np.zeros(len(walk.lp)), np.zeros(len(walk.lp))
        for p, ids in paths:
            for i in ids:
                want[i] += 3 * p / sum(x for x, _ in paths)
        lp = walk.expect([word], [3], got)
        assert np.allclose(got, want) and math.isclose(lp[0], math.log(sum(x for x, _ in paths)))


def test_lattice_sums_all_segmentations():
    walk = lattice_lm.Lattice(P.path("piece_bpe_32k.model"))

    def every(s):
        if not s:
            return 1.0
        total = sum(math.exp(walk.lp[walk.ids[s[:j]]]) * every(s[j:]) for j in range(1, len(s) + 1) if s[:j] in walk.ids)
        return total + (math.exp(walk.spelled(s[0])[0]) * every(s[1:]) if s[0] not in walk.ids else 0.0)

    for w in ("the", "reading", "naïve", "中x", "aaaaa"):
        assert math.isclose(walk.forward([w])[0], math.log(every(lattice_lm.MARK + w)), rel_tol=1e-9)
        counts = np.zeros(len(walk.lp))
        walk.expect([w], [1.0], counts)
        if all(c in walk.ids for c in w):  # the pieces cover each character once
            names = {i: p for p, i in walk.ids.items()}
            assert math.isclose(sum(x * len(names[i]) for i, x in enumerate(counts) if x), len(w) + 1)
        assert sum(counts) > 0
    words = [*(w for t in SOUP for w in t.split()), "x" * 3000, "中" * 50, "", "the"]
    each, together = np.zeros(len(walk.lp)), np.zeros(len(walk.lp))
    for w in words:
        walk.expect([w], [2.0], each)
    walk.expect(words, [2.0] * len(words), together)
    assert np.allclose(each, together) and np.allclose(walk.forward(words), [walk.forward([w])[0] for w in words])
