"""Command line: load, sweep, import, reconcile, verify, analyze, sql, nightly.

Exit codes: 0 done, 1 refused by a guard or bad arguments, 2 unexpected failure (nightly: rows missing), 3 locked,
128 + n for a nightly run that signal n ended. Nightly settings come from the environment too: TIDEMARK_MAX_ATTEMPTS and
TIDEMARK_RETRY_INTERVAL_SECONDS; a value that is no such number is passed over with a warning.
"""

from __future__ import annotations

import argparse
import fcntl
import logging
import os
import signal
import sys
import time
from datetime import datetime, timedelta

from tidemark.errors import EngineError
from tidemark.operators import guards
from tidemark.schema import CSV_DATE
from tidemark.sources import feed

log = logging.getLogger("tidemark")
# Fixed values of the nightly run: attempts, and seconds between them.
NIGHTLY_ATTEMPTS, NIGHTLY_PAUSE_S = 3, 7200
GRAINS = ("day", "month", "year")


def _when(text: str) -> datetime:
    return datetime.fromisoformat(text)


def setting(name: str, default: int, least: int) -> int:
    """A whole number from the environment; a bad one is passed over with a warning."""
    text = os.environ.get(name, "")
    if text.isascii() and text.isdigit() and int(text) >= least:
        return int(text)
    if text:
        log.warning("%s=%r is no whole number of at least %d; %d is used", name, text, least, default)
    return default


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    top.add_argument("--master")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, fed: bool = False):
        p = sub.add_parser(name)
        p.add_argument("--store", required=name != "sql")
        if fed:
            p.add_argument("--url")
            p.add_argument("--client")
            p.add_argument("--app-token", default=os.environ.get("TIDEMARK_APP_TOKEN"))
            p.add_argument("--timeout", type=float, default=feed.TIMEOUT_S)
            p.add_argument("--page-size", type=int, default=feed.PAGE_SIZE)
        return p

    for name in ("load", "nightly"):
        p = add(name, True)
        p.add_argument("--since", type=_when)
        p.add_argument("--default-since", type=_when, default=datetime(2020, 1, 1))
        p.add_argument("--overlap-hours", type=float, default=1.0)
        p.add_argument("--max-pages", type=int)
        p.add_argument("--dry-run", action="store_true")
    p.add_argument("--attempts", type=int, default=setting("TIDEMARK_MAX_ATTEMPTS", NIGHTLY_ATTEMPTS, 1))
    p.add_argument("--pause", type=float, default=setting("TIDEMARK_RETRY_INTERVAL_SECONDS", NIGHTLY_PAUSE_S, 0))
    p.add_argument("--lock", default="/tmp/tidemark.lock", help="keeps runs of one machine apart; two machines are kept apart by the store, which refuses the second writer of a version")
    p.add_argument("--failed-marker", help="file that is there while the last night is unresolved")
    p = add("sweep", True)
    p.add_argument("--from", dest="start", type=_when)
    p.add_argument("--to", dest="end", type=_when)
    p.add_argument("--window-days", type=float, default=1.0)
    p.add_argument("--resweep", action="store_true")
    p.add_argument("--parallel", action="store_true", help="read all windows at once, one commit")
    p.add_argument("--dry-run", action="store_true")
    p = add("import")
    p.add_argument("--csv", required=True)
    p.add_argument("--max-rows", type=int)
    p.add_argument("--date-format", default=CSV_DATE)
    p.add_argument("--truncate", action="store_true")
    p = add("reconcile", True)
    p.add_argument("--by", choices=GRAINS, default="month")
    p.add_argument("--from", dest="start", type=_when)
    p.add_argument("--to", dest="end", type=_when)
    p.add_argument("--daily-audit", action="store_true")
    add("verify")
    add("analyze")
    p = add("sql")
    p.add_argument("text", nargs="?")
    p.add_argument("--tables", help="folder of <name>.parquet to register as views")
    return top


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    top = parser()
    args = top.parse_args(argv)
    if args.command == "sweep":
        if not (args.start and args.end):
            top.error("a sweep needs both --from and --to")
        if args.end <= args.start:
            top.error("--to must come after --from")
        if args.window_days <= 0:
            top.error("--window-days must be positive")
    return args


def session(master: str | None = None):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC")
    return (builder.master(master) if master else builder).getOrCreate()


def register_tables(spark, folder: str, names) -> None:
    for n in names:
        spark.read.parquet(f"{folder}/{n}.parquet").createOrReplaceTempView(n)


def statements(text: str) -> list[str]:
    """A script cut at semicolons outside quotes; comments go."""
    out, part, quote, i = [], [], "", 0
    while i < len(text):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif text.startswith("--", i):
            i = text.find("\n", i) if "\n" in text[i:] else len(text)
            continue
        if c == ";" and not quote:
            out.append("".join(part))
            part = []
        else:
            part.append(c)
        i += 1
    return [s.strip() for s in [*out, "".join(part)] if s.strip()]


def run_sql(spark, text: str) -> list:
    """The result of each statement of a script."""
    return [spark.sql(s) for s in statements(text)]


def client_of(args):
    return feed.make_client({"client": args.client, "url": args.url, "token": args.app_token, "timeout": args.timeout} if args.client else {"url": args.url, "token": args.app_token, "timeout": args.timeout})


def reconcile_run(spark, store, client, grain: str, low=None, high=None):
    """Compared counts of one grain; a year's gap is counted once, whatever other grains are asked for."""
    from tidemark.operators import reconcile

    theirs = spark.createDataFrame([(k, n) for k, n in client.counts(grain, low, high).items()], "period string, n long")
    return reconcile.compare(theirs, reconcile.counts(store.fact(), "Created_Date", grain, low, high))


class Ended(BaseException):
    """A signal asked the run to end."""


def nightly(args, attempt, sleep=time.sleep) -> int:
    """Lock, try, test the shortfall, and try again after a pause; the last attempt's reason is the exit code."""
    marker = getattr(args, "failed_marker", None)

    def ended(number, _):
        raise Ended(number)

    with open(args.lock, "w") as lock:
        try:
            fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError:
            return 3
        before = {n: signal.signal(n, ended) for n in (signal.SIGINT, signal.SIGTERM)}
        code = 1
        try:
            for n in range(1, args.attempts + 1):
                try:
                    guards.shortfall(attempt())
                    code = 0
                except guards.RowsMissing as e:
                    log.error("attempt %d/%d: %s", n, args.attempts, e)
                    code = 2
                except Exception:
                    log.exception("attempt %d/%d failed", n, args.attempts)
                    code = 1
                if code == 0:
                    if n > 1:
                        log.warning("recovered: attempt %d/%d succeeded after %d that failed", n, args.attempts, n - 1)
                    if marker and os.path.exists(marker):
                        os.remove(marker)
                    return 0
                if n < args.attempts:
                    log.info("waiting %s s before attempt %d/%d; the lock is held", args.pause, n + 1, args.attempts)
                    sleep(args.pause)
            log.error("all %d attempts failed; exit code %d", args.attempts, code)
            if marker:
                with open(marker, "w") as f:
                    f.write(f"{datetime.now().isoformat(timespec='seconds')} all {args.attempts} attempts failed, exit code {code}\n")
            return code
        except Ended as e:
            log.error("ended by signal %d", e.args[0])
            return 128 + e.args[0]
        finally:
            for number, handler in before.items():
                signal.signal(number, handler)


def table_names(spark, folder: str) -> list[str]:
    """Names of the <name>.parquet in a folder of any store that Spark reaches."""
    from tidemark.shared import hadoop_path

    fs, path = hadoop_path(spark, folder)
    return sorted(n[:-8] for s in fs.listStatus(path) if (n := s.getPath().getName()).endswith(".parquet"))


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parse_args(argv)
    from tidemark.operators import load, reconcile, verify
    from tidemark.operators.store import SnapshotStore

    spark = session(args.master)
    try:
        store = SnapshotStore(spark, args.store) if args.store else None
        if args.command in ("load", "nightly"):
            one = lambda: load.incremental(store, client_of(args), args.since, args.default_since, timedelta(hours=args.overlap_hours), args.page_size, args.max_pages, args.dry_run)
            if args.command == "load":
                print(one())
                return 0

            def attempt() -> int:
                one()
                return reconcile.totals(reconcile_run(spark, store, client_of(args), "month")).first()["short"]

            return nightly(args, attempt)
        if args.command == "sweep":
            width = timedelta(days=args.window_days)
            if args.parallel:
                options = {k: str(v) for k, v in {"client": args.client, "url": args.url, "token": args.app_token, "timeout": args.timeout, "page_size": args.page_size}.items() if v}
                print(load.sweep_parallel(store, options, args.start, args.end, width, args.resweep, args.dry_run))
            else:
                print(load.sweep(store, client_of(args), args.start, args.end, width, args.page_size, args.resweep, args.dry_run))
        elif args.command == "import":
            print(load.import_csv(store, args.csv, args.date_format, args.max_rows, args.truncate))
        elif args.command == "reconcile":
            compared = reconcile_run(spark, store, client_of(args), args.by, args.start, args.end).cache()
            print(reconcile.report(f"by {args.by}", compared))
            if args.daily_audit:
                print(reconcile.daily_audit(compared))
            print(reconcile.shortfall_line(reconcile.totals(compared).first()["short"], datetime.now()))
        elif args.command == "verify":
            verify.orphan_checks(store.fact(), store.dims()).show(20, False)
            verify.load_profile(store.fact()).show(1, False, True)
        elif args.command == "analyze":
            m = store.manifest()
            for column, values in store.analyze(m).items():
                print(column, values)
            store.publish(m)
        else:
            if store:
                store.register_views()
            if args.tables:
                register_tables(spark, args.tables, table_names(spark, args.tables))
            for df in run_sql(spark, args.text or sys.stdin.read()):
                df.show(100, False)
        return 0
    except EngineError as e:
        log.error("%s", e)
        return 1
    except Exception:
        log.exception("failed")
        return 2


if __name__ == "__main__":
    sys.exit(main())
