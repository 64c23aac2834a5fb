"""Semantic layer: metric views with named dimensions and measures (M1-M3).

A metric view is a source table, a set of dimension expressions, additive states
of a row and a set of measures over sums of states. ``query(dims, measures, where)``
aggregates at exactly the requested grain, so ratio measures are re-evaluated per
group (never averaged across groups). OSS Spark has no ``WITH METRICS`` DDL; this
class is the DataFrame-level equivalent.

``cube`` adds the states up once at the finest grain (all dimensions and filter
columns); any question is then answered from the stored cells by ``query_cube``
without the source. Distinct HCPs need no distinct aggregate: the source has one
row per HCP, so each HCP is in one cell and counts of cells add up exactly.

Measures that are averages or percentages are exact DECIMAL quotients
rounded HALF_UP to ``MEASURE_SCALE`` decimals and returned as DOUBLE, so the
same question gives the same digits on any partitioning.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.numeric import quotient

MEASURE_SCALE = 4


def _ratio(num: Column, den: Column) -> Column:
    return F.round(quotient(num, den), MEASURE_SCALE).cast("double")


def _n(state: str) -> Column:
    """A count over the group's rows or cells: 0 without any."""
    return F.coalesce(F.sum(state), F.lit(0).cast("bigint"))


def _avg(state: str) -> Callable[[], Column]:
    return lambda: _ratio(F.sum(f"{state}_sum"), _n(f"{state}_n"))


def _one(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0).cast("bigint")


@dataclass
class MetricView:
    name: str
    dimensions: dict[str, Callable[[], Column]]
    states: dict[str, Callable[[], Column]]      # additive values of a source row
    measures: dict[str, Callable[[], Column]]    # over sums of states
    filters: list[str] = field(default_factory=list)   # source columns that questions filter by besides dimensions
    labels: dict[str, str] = field(default_factory=dict)

    def prepared(self, source: DataFrame) -> DataFrame:
        """The source's rows as dimensions, filter columns and states."""
        members = {**self.dimensions, **{f: _col(f) for f in self.filters if f not in self.dimensions}, **self.states}
        return source.select(*[make().alias(name) for name, make in members.items()])

    def cube(self, source: DataFrame) -> DataFrame:
        """The states added up per combination of dimensions and filter columns."""
        keys = list(dict.fromkeys([*self.dimensions, *self.filters]))
        return self.prepared(source).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in self.states])

    def query_cube(self, cells: DataFrame, dims: list[str] | None = None, measures: list[str] | None = None,
                   where: Column | None = None) -> DataFrame:
        """The measures per combination of ``dims``, from cells or prepared rows; ``where`` is on dimensions and filter columns."""
        dims = dims or []
        measures = measures or list(self.measures)
        unknown = [n for n in dims if n not in self.dimensions] + [n for n in measures if n not in self.measures]
        if unknown:
            raise KeyError(f"{self.name}: unknown members {unknown}")
        df = cells if where is None else cells.filter(where)
        aggs = [self.measures[m]().alias(m) for m in measures]
        return df.groupBy(*dims).agg(*aggs) if dims else df.agg(*aggs)

    def query(self, source: DataFrame, dims: list[str] | None = None, measures: list[str] | None = None,
              where: Column | None = None) -> DataFrame:
        """The same straight from the source; ``where`` is on its columns."""
        return self.query_cube(self.prepared(source if where is None else source.filter(where)), dims, measures)


def _col(c: str) -> Callable[[], Column]:
    return lambda: F.col(c)


def _mean_states(name: str, value: Callable[[], Column]) -> dict[str, Callable[[], Column]]:
    return {f"{name}_sum": value, f"{name}_n": lambda: _one(value().isNotNull())}


def hcp_engagement(s: Settings = DEFAULT) -> MetricView:
    """The HCP metric view; "engaged" follows the reach window of the settings. Its source has one row per HCP."""
    known = lambda: F.col("hcp_id").isNotNull()
    return MetricView(
        name="metric_hcp_engagement",
        dimensions={
            "territory": _col("territory"),
            "specialty": _col("specialty"),
            "hcp_tier": _col("hcp_tier"),
            "practice_setting": _col("practice_setting"),
            "therapeutic_area": _col("primary_therapeutic_area"),
            "top_scientific_topic": _col("top_scientific_topic"),
            "preferred_channel": _col("preferred_engagement_channel"),
        },
        filters=["influence_score"],
        states={
            "hcps": lambda: _one(known()),
            "engaged": lambda: _one(known() & (F.col("days_since_last_msl") <= s.reach_days)),
            "neglected": lambda: _one(known() & F.col("under_engaged_priority")),
            **_mean_states("engagement", lambda: F.col("engagement_score").cast("decimal(10,1)")),
            **_mean_states("need", lambda: F.col("educational_need_score").cast("decimal(10,1)")),
            **_mean_states("influence", lambda: F.col("influence_score").cast("bigint")),
            **_mean_states("open_rate", lambda: F.col("email_open_rate").cast("decimal(10,3)")),
            "visits": lambda: F.col("msl_interactions").cast("bigint"),
            "follow_ups": lambda: F.col("follow_ups_requested").cast("bigint"),
        },
        measures={
            "total_hcps": lambda: _n("hcps"),
            "hcps_engaged_90d": lambda: _n("engaged"),
            "hcp_reach_pct": lambda: _ratio(_n("engaged") * 100, _n("hcps")),
            "under_engaged_priority_hcps": lambda: _n("neglected"),
            "avg_engagement_score": _avg("engagement"),
            "avg_educational_need_score": _avg("need"),
            "avg_influence_score": _avg("influence"),
            "total_msl_interactions": lambda: F.sum("visits"),
            "avg_email_open_rate": _avg("open_rate"),
            "open_follow_ups": lambda: F.sum("follow_ups"),
        },
        labels={"hcp_tier": "HCP Tier", "total_hcps": "Total HCPs", "hcp_reach_pct": "HCP Reach Pct"},
    )


HCP_ENGAGEMENT = hcp_engagement()

MEDICAL_INQUIRIES = MetricView(
    name="metric_medical_inquiries",
    dimensions={
        "inquiry_topic": _col("inquiry_topic"),
        "evidence_type": _col("evidence_type_requested"),
        "indication": _col("indication"),
        "product": _col("product"),
        "response_status": _col("response_status"),
        "inquiry_month": lambda: F.date_trunc("month", F.col("inquiry_date")).cast("date"),
    },
    states={
        "inquiries": lambda: F.lit(1).cast("bigint"),
        "still_open": lambda: _one(F.col("response_status") == "Open"),
        "late": lambda: _one(F.col("overdue")),
        "closed": lambda: _one(F.col("response_status") == "Closed"),
        "in_time": lambda: _one(F.col("sla_met")),
        **_mean_states("days", lambda: F.col("response_time_days").cast("bigint")),
    },
    measures={
        "total_inquiries": lambda: _n("inquiries"),
        "open_inquiries": lambda: _n("still_open"),
        "overdue_inquiries": lambda: _n("late"),
        "avg_response_days": _avg("days"),
        "sla_met_pct": lambda: _ratio(_n("in_time") * 100, _n("closed")),
    },
)
