"""The scheduled job: ingest new CSV drops, rebuild silver and gold, publish the queue.

    python -m fieldlens.plans.refresh --landing <root> --out <root> --mask-key-file <file> [--as-of YYYY-MM-DD]

``<landing>/<feed>/`` holds the drop folders of each of the nine feeds. Each
run ingests only files not seen before (checkpointed bronze streams), extracts
and adds up only the notes of new batches (:mod:`.states`; a note whose text is in
the extraction cache isn't sent to the extractor again), rebuilds the other silver
tables and the gold tables, and publishes tables and the keyed serving snapshot once they are complete. Every output lives under ``<out>``,
which on a cluster is shared storage.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.common import path_has_files
from ..operators import extract as X
from ..operators import serving as SV
from ..sources.feeds import BATCH_COLUMN, FEEDS
from ..streaming import bronze as B
from . import publish as PB
from .catalog import Lakehouse
from .states import NoteStates


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def ingest_all(spark: SparkSession, landing: str, out: str) -> dict[str, str]:
    """Run every feed's bronze stream once (availableNow), side by side; returns bronze table paths."""
    paths = {feed: _join(out, "bronze", feed) for feed in FEEDS}
    runs = [B.start(spark, feed, _join(landing, feed, "*"), table, _join(out, "_checkpoints", feed))
            for feed, table in paths.items()]
    for run in runs:
        B.finish(run)
    return paths


def store_new_notes(spark: SparkSession, notes: str, out: str, extractor=None) -> NoteStates | None:
    """Extract and add up the batches of notes that the store under ``out`` doesn't have; None before the first note."""
    store = NoteStates(spark, _join(out, "note_states"))
    if not path_has_files(spark, notes):
        return None
    rows = B.read_bronze(spark, "msl_interactions", notes)
    newest = rows.agg(F.max(BATCH_COLUMN)).first()[0]
    if newest is None:
        return None
    cache = _join(out, "extract_cache")
    store.update(newest, lambda after: X.extract_incremental(spark, rows.where(F.col(BATCH_COLUMN) > after), cache, extractor))
    return store


def run_refresh(spark: SparkSession, landing: str, out: str, settings: Settings = DEFAULT,
                extractor=None) -> dict[str, str]:
    bronze = ingest_all(spark, landing, out)
    lh = Lakehouse(spark, None, settings, extractor=extractor, bronze_paths=bronze)
    store = store_new_notes(spark, bronze["msl_interactions"], out, extractor)
    stored = {}
    if store:
        lh.replace("note_rollup", store.rollup(settings))
        stored["silver_extracted"] = store.folders("extracted")
    written = lh.refresh(_join(out, "tables"), stored=stored)
    queue = SV.action_queue(lh.table("next_best_engagement"))
    SV.publish_snapshot(queue, _join(out, "serving", "msl_action_queue"))
    now = PB.current(spark, _join(out, "serving", "msl_action_queue"))
    written["msl_action_queue"] = now[1]
    return written


def land_bound_feeds(spark: SparkSession, sf_dir: str, landing: str, wave: str,
                     settings: Settings = DEFAULT) -> None:
    """Demo upstream: drop the feeds bound from the star-schema tables as CSV.

    ``wave="older"`` lands only the superseded HCP versions; ``wave="current"``
    lands everything else, so the newest-version rule sees two ingest times.
    """
    from ..sources.tables import StarTables
    from ..sources.testbind import HCP_CURRENT_TS, bind_feed

    star = StarTables(spark, sf_dir)
    for feed in FEEDS:
        df = bind_feed(star, feed, settings)
        older = F.col("_ingested_at") < F.lit(HCP_CURRENT_TS).cast("timestamp")
        if wave == "older":
            if feed != "hcp_master":
                continue
            df = df.filter(older)
        elif feed == "hcp_master":
            df = df.filter(~older)
        B.drop_files(df, _join(landing, feed, f"drop-{wave}"))


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=DEFAULT.as_of.isoformat())
    ap.add_argument("--mask-key-file", required=True, help="file with the secret of the masked identifiers (1 to 64 bytes)")
    args = ap.parse_args()
    from ..session import build_session

    spark = build_session(os.environ.get("SPARK_MASTER"))
    with open(args.mask_key_file) as f:
        secret = f.read().strip()
    if secret == DEFAULT.mask_key:
        raise SystemExit("the mask key must be an own secret")
    settings = Settings(as_of=dt.date.fromisoformat(args.as_of), mask_key=secret)
    for name, path in run_refresh(spark, args.landing, args.out, settings).items():
        print(name, path)


if __name__ == "__main__":
    main()
