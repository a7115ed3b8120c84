"""Command line over a store: python -m bandsieve.cli --store DIR COMMAND."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.functions.bands import DEFAULT_BANDS
from bandsieve.operators import cascade, evaluate, explore, reports, stages, versions
from bandsieve.session import cluster_session
from bandsieve.sources import files
from bandsieve.sources.store import Store


def table(df: DataFrame, markdown: bool = False) -> str:
    """A small result as text or as a Markdown table."""
    rows = [[str(x) for x in df.columns], *[["" if v is None else str(v) for v in r] for r in df.collect()]]
    if markdown:
        return "\n".join("| " + " | ".join(r) + " |" for r in [rows[0], ["-"] * len(rows[0]), *rows[1:]])
    width = [max(map(len, c)) for c in zip(*rows)]
    return "\n".join("  ".join(x.ljust(w) for x, w in zip(r, width)).rstrip() for r in rows)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bandsieve", description=__doc__)
    p.add_argument("--store", required=True)
    p.add_argument("--bands", help="JSON file with bands over the shipped ones")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("catalog", help="add new files")
    c.add_argument("root")
    c.add_argument("--pattern", default="*.mp4")
    c.add_argument("--top", default="processed_v3")
    sub.add_parser("status", help="rows done by stage and version")
    c = sub.add_parser("download", help="fetch the objects of a listing (Parquet: key, size) that are missing or empty here")
    c.add_argument("listing")
    c.add_argument("folder")
    c.add_argument("--fetch", required=True, help="MODULE:NAME of a function from a key to bytes")
    c = sub.add_parser("run", help="run stages over what their gates pass on and no row has yet")
    c.add_argument("--stages", required=True, help="MODULE:NAME of a list of stages")
    c.add_argument("--stage", help="only this one")
    c.add_argument("--limit", type=int)
    c = sub.add_parser("judge", help="run the judge over unsure clips, or over a sample of those that nothing speaks against")
    c.add_argument("--stages", required=True, help="MODULE:NAME of a list of stages, one of them vlm")
    c.add_argument("--limit", type=int)
    c.add_argument("--sample", type=int, help="so many clean clips instead")
    c = sub.add_parser("funnel", help="where clips leave the cascade")
    c.add_argument("--md", action="store_true")
    sub.add_parser("verdict", help="assemble and store one verdict a clip")
    c = sub.add_parser("bad", help="clips that are confirmed bad, and those that wait for the judge")
    c.add_argument("--out")
    c.add_argument("--min", type=int, default=1, help="only clips with at least so many reasons")
    c = sub.add_parser("eval", help="bootstrap, score, compare or confirm")
    c.add_argument("what", choices=["bootstrap", "score", "compare", "confirm"])
    c.add_argument("--stage", default="cheap_cv")
    c.add_argument("--version")
    c.add_argument("--gold")
    c.add_argument("--n", type=int, default=50)
    c = sub.add_parser("explore", help="near-duplicates and outliers of a vector store")
    c.add_argument("vectors")
    c.add_argument("--encoder", required=True)
    c.add_argument("--dup", type=float, default=0.95)
    c.add_argument("--top", type=int, default=20)
    c.add_argument("--out")
    c = sub.add_parser("snapshot", help="the public summary as JSON")
    c.add_argument("--out")
    return p


def emit(value: object, out: str | None) -> str:
    text = json.dumps(value, indent=2, sort_keys=True)
    if out:
        with open(out, "w") as f:
            f.write(text + "\n")
    return text


def named(name: str) -> object:
    """What MODULE:NAME names."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def run(args: list[str], spark=None) -> str:  # noqa: ANN001
    a = parser().parse_args(args)
    spark = spark or cluster_session()
    store = Store(spark, a.store)
    bands = files.load_bands(spark, a.bands) if a.bands else DEFAULT_BANDS
    now = time.time()
    if a.command == "catalog":
        found = files.catalog(spark, a.root, a.pattern, a.top, now)
        store.add_videos(found)
        return f"{found.count()} files found"
    if a.command == "download":
        got, left = files.download(spark, named(a.fetch), spark.read.parquet(a.listing), files.local_objects(spark, a.folder), a.folder)
        return f"{got} fetched, {left} still missing"
    if a.command in ("run", "judge"):
        todo = [x for x in named(a.stages) if x.name == (a.stage if a.command == "run" and a.stage else x.name if a.command == "run" else "vlm")]
        if a.command == "judge" and a.sample:
            clean = cascade.sample_paths(cascade.clean_candidates(store.videos(), store.results()), a.sample)
            todo = [replace(x, gate=lambda results: clean) for x in todo]
        return json.dumps(stages.run_stages(store, todo, a.limit))
    if a.command == "status":
        return table(reports.status_matrix(store.videos(), store.results()).orderBy("stage", "version"))
    if a.command == "funnel":
        parts = cascade.funnel_by_layer(store.videos(), store.results(), bands).orderBy("stage", "exit"), cascade.funnel(store.videos(), store.results(), bands)
        return "\n\n".join(table(p, a.md) for p in parts)
    if a.command == "verdict":
        return table(stages.write_verdicts(store, bands, now).groupBy("verdict").count().orderBy("verdict"))
    if a.command == "bad":
        rows = cascade.suspects(store.results()).filter(F.size("reasons") >= a.min)
        counts = {r["how"]: r["count"] for r in rows.groupBy("how").count().collect()}
        if a.out:  # one JSON line a clip, written by the executors
            rows.filter("how <> 'cleared'").orderBy(F.desc(F.size("reasons")), "path").write.mode("overwrite").json(a.out)
        return emit({"n_confirmed_bad": counts.get("hard", 0) + counts.get("vlm", 0), "n_pending": counts.get("pending", 0), "n_cleared": counts.get("cleared", 0)}, None)
    if a.command == "eval":
        if a.what == "bootstrap":
            evaluate.bootstrap(store.videos(), a.n).write.mode("overwrite").json(a.gold)
            return f"draft of {a.n} clips in {a.gold}"
        if a.what == "compare":
            return table(evaluate.compare(store.history(), a.stage).orderBy("version", "category"))
        if a.what == "confirm":
            out = evaluate.confirm(store.results()).filter(F.col("stage") == a.stage).withColumns({"recall": F.lit(None), "f1": F.lit(None), "ran_at": F.lit(now)})
        else:
            rows = store.results().filter(F.col("stage") == a.stage)
            rows = rows.filter(F.col("version") == a.version) if a.version else versions.latest_run(rows)
            out = evaluate.score_against_gold(rows, files.gold(spark, a.gold)).withColumns({"stage": F.lit(a.stage), "version": F.lit(a.version).cast("string"), "ran_at": F.lit(now)})
        store.add_eval(out)
        return table(out.drop("ran_at").orderBy("category"))
    if a.command == "explore":
        vectors = files.vectors(spark, a.vectors, a.encoder).withColumn("key", F.xxhash64("id"))
        return emit(explore.findings(vectors, a.dup, a.top, id_col="key", vec_col="vector"), a.out)
    verdicts = store.results().filter("stage = 'verdict'").select("path", "verdict.verdict", "verdict.by")
    return emit(reports.snapshot(store.videos(), store.results(), verdicts, bands), a.out)


def main() -> None:
    print(run(sys.argv[1:]))


if __name__ == "__main__":
    main()
