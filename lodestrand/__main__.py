"""python -m lodestrand feed | notices | all | legislation: runs over fetched files, or over addresses. Unknown options are ignored.

With --url a feed is fetched first; --folder names a landing folder that stands for the network, --ponte the address of a
gateway for refused requests, to which the refused one is appended. Legislation lists the archive page --pagina from year
--dal to --al, with --coordinati INDEX also the consolidated texts; --max-nuovi, --minuti and --pausa (milliseconds) bound it.
--push without a target is a run that is not configured. The counters of a run go to the file named by GITHUB_STEP_SUMMARY.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time


def main(args: list[str]) -> int:
    p = argparse.ArgumentParser(prog="lodestrand")
    p.add_argument("what", choices=["feed", "notices", "all", "legislation"])
    for name in ("path", "formato", "tipo", "base", "selettori", "dettaglio", "dettagli", "target", "catalogo", "url", "folder", "ponte", "pagina", "coordinati"):
        p.add_argument(f"--{name}")
    p.add_argument("--fonte", type=int, default=0)
    p.add_argument("--giorni-avanti", type=int, default=30)
    p.add_argument("--limit", type=int, default=10)
    for name in ("dal", "al", "max-nuovi", "minuti"):
        p.add_argument(f"--{name}", type=int)
    p.add_argument("--pausa", type=int, default=1200)
    p.add_argument("--push", action="store_true")
    a, _ = p.parse_known_args(args)
    from pyspark.sql import SparkSession

    from .operators.sinks import pretty, summary
    from .plans import crawl, runner
    from .sources import catalogue, notices, rest

    if not (a.pagina if a.what == "legislation" else a.path or a.url):
        print("--path, --url or --pagina is required", file=sys.stderr)
        return runner.USAGE
    if a.push and not a.target:
        print("--push needs --target", file=sys.stderr)
        return runner.UNCONFIGURED
    transport = rest.from_folder(a.folder) if a.folder else rest.get
    gateway = rest.through(a.ponte, transport) if a.ponte else None
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = dt.datetime.now(dt.UTC)
    if a.what == "all":
        code, failed = runner.run_all(spark, catalogue.read(spark, a.catalogo), a.path, now, a.target)
        print(f"failed: {', '.join(failed) or 'none'}", file=sys.stderr)
        return code
    if a.url and not a.path:
        a.path = crawl.landed(spark, a.url, crawl.Fetcher(transport, gateway, pause=0))
    if a.what == "legislation":
        until = time.time() + 60 * a.minuti if a.minuti is not None else None
        fetch = crawl.Fetcher(transport, gateway, a.pausa / 1000, until=until)
        done = crawl.legislation(spark, a.pagina, now.year - 1 if a.dal is None else a.dal, now.year if a.al is None else a.al, fetch, a.target, a.coordinati, a.max_nuovi)
    elif a.what == "notices":
        done = runner.run_notices(spark, a.path, a.base, a.fonte, a.limit, a.target)
    else:
        job = runner.Job(a.path, a.tipo or "notizia", a.formato or "rss", a.fonte, a.base, a.selettori, a.dettaglio, a.dettagli, a.giorni_avanti, target=a.target)
        done = runner.run(spark, job, now)
    if done.error:
        print(f"error: {done.error}", file=sys.stderr)
    elif not a.target and a.what == "notices":
        for line in notices.bullets(done.rows):
            print(line)
    elif not a.target:
        for row in pretty(done.rows):
            print(row)
    print(done.counts, file=sys.stderr)
    if os.environ.get("GITHUB_STEP_SUMMARY"):
        with open(os.environ["GITHUB_STEP_SUMMARY"], "a") as f:
            f.write(summary(done.counts))
    return done.code


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
