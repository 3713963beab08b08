"""One warehouse state built lazily from the fleet sources (optionally as of a batch cut)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.functions import ts_lit
from cabwh.operators.writes import one_per_key
from cabwh.plans import dims, facts
from cabwh.sources.fixtures import Sources, load_sources


class Warehouse:
    """Facts and dimensions of one full load.

    ``cut`` (a timestamp text) builds the state a load at that moment would have seen:
    rides, events and payments up to the cut. Dimensions are the first load of the
    sources (drivers / cars without their later deltas; clients from rides up to the cut).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cut: str | None = None, sources: Sources | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cut = cut
        self.src = sources or load_sources(spark, sf_dir)

    def _upto(self, df: DataFrame, col: str) -> DataFrame:
        return df if self.cut is None else df.filter(F.col(col) <= ts_lit(self.cut))

    @cached_property
    def rides(self) -> DataFrame:
        return self._upto(self.src.rides, "dt")

    @cached_property
    def movement(self) -> DataFrame:
        return self._upto(self.src.movement, "dt")

    @cached_property
    def fact_waybills(self) -> DataFrame:
        return facts.build_fact_waybills(self.src.waybills, self.src.drivers)

    @cached_property
    def finished(self) -> DataFrame:
        return facts.finished_rides(self.movement, self.rides)

    @cached_property
    def lookup(self) -> DataFrame:
        return facts.ride_driver_lookup(self.finished, self.fact_waybills, self.rides)

    @cached_property
    def fact_rides_all(self) -> facts.FactRides:
        return facts.build_fact_rides(self.movement, self.rides, self.fact_waybills)

    @property
    def fact_rides(self) -> DataFrame:
        return self.fact_rides_all.rides

    def fact_rides_ended(self, lo=None, hi=None) -> DataFrame:
        """fact_rides restricted to ``lo <= ride_end_dt < hi`` before the driver lookup."""
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("ride_end_dt") >= ts_lit(lo))
        if hi is not None:
            cond = cond & (F.col("ride_end_dt") < ts_lit(hi))
        return facts.build_fact_rides(self.movement, self.rides, self.fact_waybills, where=cond).rides

    @cached_property
    def fact_payments(self) -> DataFrame:
        fp = one_per_key(facts.build_fact_payments(self.src.payments), ["transaction_id"])
        return self._upto(fp, "transaction_dt")

    @cached_property
    def dim_drivers(self) -> DataFrame:
        """First load of the drivers, then their day-12 delta (strict SCD2)."""
        first = dims.apply_drivers(None, dims.drivers_delta(self.src.drivers))
        if self.cut is not None:
            return first
        return dims.apply_drivers(first, dims.drivers_delta(self.src.drivers_delta), mode="strict")

    @cached_property
    def dim_cars(self) -> DataFrame:
        first = dims.apply_cars(None, dims.cars_delta(self.src.car_pool))
        if self.cut is not None:
            return first
        return dims.apply_cars(first, dims.cars_delta(self.src.car_pool_delta), mode="strict")

    @cached_property
    def dim_clients(self) -> DataFrame:
        return dims.apply_clients(None, dims.clients_delta(self.rides))
