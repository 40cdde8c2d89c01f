"""All models over published tables: refresh a layer, check it, go on."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.joins import hot_keys
from tidemark.operators.quality import Check, gate, run_checks
from tidemark.plans import gold
from tidemark.plans.checks import bronze_checks, gold_checks, silver_checks
from tidemark.plans.layers import (
    BRONZE,
    SILVER,
    bronze,
    quarantine_invalid_bookings,
    silver,
    snapshot,
)
from tidemark.session import tune_feeds
from tidemark.sources.calendar import END, START, date_dimension
from tidemark.sources.changes import ChangeLog
from tidemark.sources.landing import CORRUPT
from tidemark.sources.raw import RawStore, stream_id
from tidemark.sources.schemas import LANDING_FOLDERS, raw_schema
from tidemark.sources.tables import PublishedTable
from tidemark.streaming.ingest import load_raw, stream_landing

FIRST_MARK = datetime(2000, 1, 1, tzinfo=timezone.utc)
SNAPSHOTS = {"hosts": "host_id", "listings": "listing_id"}
MODEL_THREADS = 4
# Facts are stored by month of this column; read(buckets=[month]) lists no other.
MONTH_OF = {
    "gold_fct_bookings": "check_in_date",
    "gold_fct_reviews": "reviewed_at",
    "gold_fct_listing_events": "event_timestamp",
    "gold_fct_sessions": "session_started_at",
    # an upsert into these rewrites the months of its rows, not hash buckets of all months
    "silver_bookings": "check_in_date",
    "silver_reviews": "reviewed_at",
    "silver_listing_events": "event_timestamp",
}


class Warehouse:
    """Published tables of every model below one folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 64,
        calendar: tuple[str, str] = (START, END),
    ):
        self.spark = tune_feeds(spark)
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.calendar = calendar
        self.raw = RawStore(self.spark, f"{self.root}/raw")
        self.changes = ChangeLog(self.spark, f"{self.root}/changes")

    def table(self, model: str) -> PublishedTable:
        layer, _, entity = model.partition("_")
        keys = {"bronze": BRONZE, "silver": SILVER}.get(layer, {}).get(entity)
        return PublishedTable(
            self.spark,
            f"{self.root}/{model}",
            keys.keys if keys else (),
            self.buckets,
            "_loaded_at" if keys else None,
            F.date_format(MONTH_OF[model], "yyyy-MM") if model in MONTH_OF else None,
        )

    def read(self, model: str) -> DataFrame:
        frame = self.table(model).read()
        if frame is None:
            raise LookupError(f"{model} was never published")
        return frame

    def tables(self) -> dict[str, DataFrame]:
        """Every published model by name."""
        found = {m: self.table(m).read() for m in MODELS}
        return {m: df for m, df in found.items() if df is not None}

    # ---- RAW ----------------------------------------------------------------
    def load(self, root: str, checkpoints: str, entities: Sequence[str] = tuple(BRONZE)) -> None:
        """Append the files that have landed since the last call to RAW."""
        running = [
            load_raw(
                self.spark,
                self.raw,
                entity,
                f"{root.rstrip('/')}/{LANDING_FOLDERS[entity]}",
                raw_schema(entity),
                f"{checkpoints.rstrip('/')}/{entity}",
            )
            for entity in entities
        ]
        for query in running:
            query.awaitTermination()

    def ingest(
        self, entity: str, root: str, checkpoint: str, interval: str | None = None
    ) -> StreamingQuery:
        """Stream one entity's landing folder into RAW and its bronze table."""
        table = self.table(f"bronze_{entity}")

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            source = stream_id(self.spark, checkpoint)
            self.raw.append(entity, batch, f"{source}-{batch_id}")
            # the log decides what RAW takes; bronze takes the whole batch, since files that
            # another load put into RAW may lie below the mark this batch sets
            columns = [f.name for f in raw_schema(entity)]
            if not table.has_batch(batch_id, source):
                good = batch.filter(F.col(CORRUPT).isNull())
                rows = BRONZE[entity].latest(good.select(*columns, "_source_file", "_loaded_at"))
                taken = self.changes.append(f"bronze_{entity}", rows, table.next_version())
                table.merge(taken, batch_id=batch_id, source=source)
            mine = F.col("load") == f"{source}-{batch_id}"
            self.raw.take(f"bronze_{entity}", self.raw.loads(entity).filter(mine))

        path = f"{root.rstrip('/')}/{LANDING_FOLDERS[entity]}"
        schema = raw_schema(entity)
        return stream_landing(self.spark, path, schema, checkpoint, on_batch, interval)

    # ---- layers -------------------------------------------------------------
    def run_bronze(self, raws: Mapping[str, DataFrame] | None = None) -> None:
        """From RAW, the loads each table has not taken; or from given frames, above its mark."""

        def one(entity: str) -> None:
            model = f"bronze_{entity}"
            table = self.table(model)
            mark = table.high_water(FIRST_MARK) if table.exists() else None
            # silver reads what was taken in, not the whole table it went into
            run = table.next_version()
            if raws is not None:
                table.merge(self.changes.append(model, bronze(entity, raws[entity], mark), run))
                return
            loads = self.raw.pending(entity, model) if self.raw.exists(entity) else None
            if loads is None or loads.isEmpty():
                return
            rows = bronze(entity, self.raw.read(entity, loads=loads))
            guard = _late(loads, "stamped", mark)
            table.merge(self.changes.append(model, rows, run), order_guard=guard)
            self.raw.take(model, loads)

        self._together(one, list(BRONZE) if raws is None else list(raws))

    def run_silver(self, entities: Sequence[str] = tuple(SILVER)) -> None:
        """From bronze: all of it the first time, then what later bronze runs took in."""

        def one(entity: str) -> None:
            now, table = self.table(f"bronze_{entity}").manifest(), self.table(f"silver_{entity}")
            if now is None or self.changes.seen(f"silver_{entity}") == now["version"]:
                return
            rows = self.new_bronze(entity, now["version"])
            mark = table.high_water(FIRST_MARK) if table.exists() else None
            table.merge(silver(entity, rows), order_guard=_late(rows, "_loaded_at", mark))
            self.changes.saw(f"silver_{entity}", now["version"])

        self._together(one, entities)
        if "bookings" in entities:
            bookings = self.read("silver_bookings")
            self._rebuild("quarantine_invalid_bookings", quarantine_invalid_bookings(bookings))

    def new_bronze(self, entity: str, upto: int) -> DataFrame:
        """The bronze rows, up to run ``upto``, that silver has not seen; only their runs are listed."""
        model, source = f"bronze_{entity}", self.read(f"bronze_{entity}")
        seen = self.changes.seen(f"silver_{entity}")
        if seen is None or not self.changes.exists(model):
            return source
        return self.changes.after(model, source.schema, BRONZE[entity].keys, seen, upto)

    def run_snapshots(self, run_ts: str | datetime) -> None:
        """Only open versions are read and written; closed ones stay as they are."""

        def one(entity: str) -> None:
            source = self.read(f"silver_{entity}")
            self.table(f"{entity}_snapshot").roll(
                lambda before: snapshot(entity, before, source, run_ts), F.col("valid_to").isNull()
            )

        self._together(one, list(SNAPSHOTS))

    def run_gold(self) -> None:
        self._rebuild("gold_dim_guests", gold.dim_guests(self.read("silver_guests")))
        self._rebuild("gold_dim_hosts", gold.dim_hosts(self.read("hosts_snapshot")))
        self._rebuild("gold_dim_listings", gold.dim_listings(self.read("listings_snapshot")))
        guests, hosts, listings = map(
            self.read, ("gold_dim_guests", "gold_dim_hosts", "gold_dim_listings")
        )
        dates = date_dimension(self.spark, *self.calendar)
        first, last = (datetime.fromisoformat(d) for d in self.calendar)
        days = (last - first).days + 1
        bookings, reviews, events = (
            self.read(f"silver_{e}") for e in ("bookings", "reviews", "listing_events")
        )
        hot = gold.booking_hot_keys(bookings)
        self._rebuild(
            "gold_fct_bookings",
            gold.fct_bookings(bookings, listings, hosts, guests, dates, days, hot),
        )
        facts = self.read("gold_fct_bookings")
        hot = gold.review_hot_keys(reviews)
        self._rebuild(
            "gold_fct_reviews",
            gold.fct_reviews(reviews, facts, listings, hosts, guests, dates, days, hot),
        )
        hot = gold.event_hot_keys(events)
        self._rebuild(
            "gold_fct_listing_events",
            gold.fct_listing_events(events, listings, guests, dates, days, hot),
        )
        self._rebuild(
            "gold_fct_sessions", gold.fct_sessions(events, listings, guests, dates, days, hot)
        )
        hot = hot_keys(facts, {"guest_key": "guest_key"})
        self._rebuild(
            "gold_obt_bookings", gold.obt_bookings(facts, guests, dates, days=days, hot=hot)
        )

    def report(self, checks: list[Check]) -> DataFrame:
        return run_checks(checks, self.tables())

    def refresh(self, raws: Mapping[str, DataFrame] | None, run_ts: str | datetime) -> None:
        """One full run, from RAW when ``raws`` is None. A layer with violations stops the rest."""
        self.run_bronze(raws)
        gate(self.report(bronze_checks()))
        self.run_silver()
        gate(self.report(silver_checks()))
        self.run_snapshots(run_ts)
        self.run_gold()
        gate(self.report(gold_checks()))

    # ---- sinks --------------------------------------------------------------
    def _together(self, step: Callable[[str], None], names: Sequence[str]) -> None:
        """Run independent models side by side: their small stages share the cluster."""
        with ThreadPoolExecutor(MODEL_THREADS) as pool:
            for done in [pool.submit(inheritable_thread_target(self.spark)(step), n) for n in names]:
                done.result()

    def _rebuild(self, model: str, df: DataFrame) -> None:
        self.table(model).overwrite(df)


def _late(rows: DataFrame, stamp: str, mark: datetime | None) -> str | None:
    """The order column, if some of ``rows`` are older than what a table holds already.

    A slow load is taken after later ones; its rows must not replace theirs.
    """
    if mark is None or not rows.agg(F.min(stamp) < F.lit(mark)).first()[0]:
        return None
    return "_loaded_at"


MODELS = (
    *[f"bronze_{e}" for e in BRONZE],
    *[f"silver_{e}" for e in SILVER],
    "quarantine_invalid_bookings",
    *[f"{e}_snapshot" for e in SNAPSHOTS],
    "gold_dim_guests",
    "gold_dim_hosts",
    "gold_dim_listings",
    "gold_fct_bookings",
    "gold_fct_reviews",
    "gold_fct_listing_events",
    "gold_fct_sessions",
    "gold_obt_bookings",
)
