"""Models by name, built in dependency order into stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from candlewick.plans import dims, facts, marts, staging
from candlewick.session import drop_scratch
from candlewick.sources.refs import Refs
from candlewick.tables import incremental
from candlewick.tables.store import Table


@dataclass(frozen=True)
class Model:
    """A named function from DataFrames to a DataFrame and how its result is kept."""

    name: str
    build: Callable[..., DataFrame]
    needs: Sequence[str] = ()
    kept_as: str = "table"  # view | table | incremental
    strategy: str | None = None
    unique_key: Sequence[str] = ()
    on_schema_change: str = "ignore"
    partition_by: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    reads_itself: bool = False
    indexed: bool = False  # keep what each file may hold of the unique key, so that a merge rewrites few files
    options: dict = field(default_factory=dict)
    check: Callable[[DataFrame], DataFrame] | None = None  # failing rows of the stored result


class CheckFailed(ValueError):
    """A stored model holds rows that its check refuses."""


class Project:
    def __init__(self, spark: SparkSession, refs: Refs, root: str):
        self.spark, self.refs, self.root = spark, refs, root.rstrip("/")
        self.models: dict[str, Model] = {}

    def add(self, model: Model) -> None:
        self.models[model.name] = model

    def order(self) -> list[str]:
        graph = {m.name: [n for n in m.needs if n in self.models] for m in self.models.values()}
        return list(TopologicalSorter(graph).static_order())

    def table(self, name: str) -> Table:
        m = self.models[name]
        return Table(self.spark, f"{self.root}/{name}", m.partition_by, key=m.unique_key if m.indexed else ())

    def _input(self, name: str) -> DataFrame:
        if name in self.models:
            return self.refs.ref(name)
        group, _, table = name.partition(".")
        return self.refs.source(group, table)

    def run(self, full_refresh: bool = False) -> list[str]:
        """Build every model once; a view is resolved again whenever it is read."""
        done = self.order()
        for name in done:
            m = self.models[name]
            make = lambda m=m: m.build(*[self._input(n) for n in m.needs])
            if m.kept_as == "view":
                self.refs.add_model(name, make)
                continue
            table = self.table(name)
            if m.kept_as == "table":
                table.replace(make(), m.cluster_by)
            else:
                known = {}
                if m.reads_itself and incremental.is_incremental(table, full_refresh):
                    known["existing"] = table.read()
                rows = m.build(*[self._input(n) for n in m.needs], **known)
                incremental.load(
                    table, rows, m.strategy, m.unique_key, m.on_schema_change, full_refresh,
                    cluster_by=m.cluster_by, **m.options,
                )
            if m.check is not None:
                failing = m.check(table.read()).limit(5).collect()
                if failing:
                    raise CheckFailed(f"{name}: {failing}")
            self.refs.add_model(name, table.read)
        return done

    def finish(self) -> None:
        """Remove this application's intermediate tables, once its results are stored and read."""
        drop_scratch(self.spark)


def market_models(spark: SparkSession, refs: Refs, root: str, start=dims.DATE_START, end=dims.DATE_END) -> Project:
    """The whole layer set: silver views, dimensions, facts, marts."""
    p = Project(spark, refs, root)
    daily = ["fct_ohlcv_daily"]
    by_day = ("open_date", "asset_pair_symbol")
    star = ["trades_fct", "date_dim"]
    for m in [
        Model("stg_agg_trades", staging.stg_agg_trades, ["raw.agg_trades"], "view"),
        Model("stg_assets", staging.stg_assets, ["raw.scd_raw_assets"], "view"),
        Model("stg_kline", partial(staging.stg_klines, coordinates=True), ["raw.kline"], "view"),
        Model(
            "streamed_ohlcv", staging.streamed_by_day, ["stg_kline"], "incremental", "merge",
            ["asset_symbol", "open_time", "candle_date"], partition_by=["candle_date"], reads_itself=True,
            options={"partition_in_key": True},
        ),
        Model("stg_ohlcv", staging.stg_ohlcv, ["raw.ohlcv", "streamed_ohlcv"], "view"),
        Model("assets_dim", dims.assets_dim, ["stg_assets"]),
        Model("date_dim", lambda: dims.calendar(spark, start, end)),
        Model("time_dim", lambda: dims.time_dim(spark)),
        Model(
            "ohlcv_fct", facts.fct_ohlcv_hourly, ["stg_ohlcv", "assets_dim", "date_dim"], "incremental", "merge",
            ["ohlcv_sk"], reads_itself=True, indexed=True,
        ),
        Model(
            "trades_fct", facts.fct_trades, ["stg_agg_trades", "assets_dim", "date_dim"], "incremental", "merge",
            ["trades_sk", "transaction_date"], "fail", ["transaction_date"], reads_itself=True,
            options={"partition_in_key": True}, check=marts.outside_calendar,
        ),
        Model("fct_ohlcv_daily", facts.fct_ohlcv_daily, ["ohlcv_fct"], cluster_by=by_day),
        Model(
            "fct_technical_daily", facts.fct_technical_daily, daily, "incremental", "merge", ["technical_sk"],
            cluster_by=by_day, reads_itself=True, indexed=True,
        ),
        Model(
            "fct_liquidity_daily", facts.fct_liquidity_daily, daily, "incremental", "merge", ["liquidity_sk"],
            cluster_by=by_day, reads_itself=True, indexed=True,
        ),
        Model("daily_pressure_fact", facts.fct_pressure_daily, daily, cluster_by=by_day),
        Model("vw_gold_market_daily", facts.market_daily_wide, [*daily, "date_dim", "assets_dim"]),
        Model("aggregated_trade_value_by_pair_symbol", marts.trade_size_distribution, ["trades_fct"]),
        Model("asset_market_share", marts.market_share, [*star, "assets_dim"]),
        Model("average_time_between_trades", partial(marts.time_between_trades, stored=True), star),
        Model("average_trade_price_by_hour_and_asset", marts.price_by_hour, ["trades_fct", "time_dim", "date_dim"]),
        Model("daily_trading_volume_by_asset", marts.daily_volume, star),
        Model("intraday_trading_volume_pattern", marts.intraday_pattern, ["trades_fct", "time_dim"]),
        Model("large_trades_impact", marts.large_trades, star),
        Model("trading_intensity_by_hour", marts.trading_intensity, ["trades_fct", "time_dim", "date_dim"]),
        Model("trading_velocity", marts.trading_velocity, ["trades_fct"]),
        Model("volatility_7_day", partial(marts.volatility_rows, stored=True), ["trades_fct"]),
    ]:
        p.add(m)
    return p
