"""Log views derived from the sample tables (see FIXTURES.md), as DataFrames."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.functions.timecols import stamp
from viewpulse.model import DELIMITER, LOGS

AREA = ("probe_id", "province_id", "city_id", "platform", "device_provider", "fw_version")


def _text(column: Column) -> Column:
    return column.cast("string")


class Views:
    """Lazily built log views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _customers(self) -> DataFrame:
        return self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")

    @staticmethod
    def _named(customers: DataFrame) -> DataFrame:
        """The box of each row, with the numeric key its id is made of; other columns stay."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        others = [c for c in customers.columns if c not in ("c_custkey", "c_nationkey", "c_mktsegment")]
        return customers.select(
            *others, key.alias("_key"), F.concat(F.lit("p"), _text(key)).alias("probe_id"),
            F.concat(F.lit("d"), _text(key)).alias("device_id"), _text(nation).alias("province_id"),
            _text(nation * 10 + key % 10).alias("city_id"), F.col("c_mktsegment").alias("platform"),
            F.concat(F.lit("dev"), _text(key % 7)).alias("device_provider"),
            F.concat(F.lit("fw"), _text(key % 3)).alias("fw_version"))

    def _boxes(self) -> DataFrame:
        """One row per box, with the numeric key its id is made of."""
        return self._named(self._customers())

    @cached_property
    def terminal_info(self) -> DataFrame:
        return self._boxes().drop("_key")

    def _of_orders(self, *columns: str) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", *columns)
        return orders.join(self._boxes(), F.col("o_custkey") == F.col("_key"))

    def _of_lines(self, *columns: str) -> DataFrame:
        """Lines meet orders that have their customer already, so lines move once; texts are made after that."""
        lines = self.table("lineitem").select("l_orderkey", *columns)
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        owned = orders.join(self._customers(), F.col("o_custkey") == F.col("c_custkey"))
        return self._named(lines.join(owned, F.col("l_orderkey") == F.col("o_orderkey")))

    def _of_events(self) -> DataFrame:
        return self.table("events").join(self._boxes(), F.col("user_id") == F.col("_key"))

    @cached_property
    def terminal_report(self) -> DataFrame:
        area = [c for c in AREA if c != "fw_version"]
        return self._of_orders("o_orderdate").select(
            *area, "device_id", F.concat(F.lit("fw"), _text(F.col("o_orderkey") % 3)).alias("fw_version"),
            F.col("o_orderdate").alias("event_time"), F.col("o_orderkey").alias("seq"))

    @cached_property
    def state(self) -> DataFrame:
        return self.table("events").where(F.col("event_type").isin("view", "signup")).select(
            F.concat(F.lit("p"), _text(F.col("user_id"))).alias("probe_id"),
            F.concat(F.lit("h"), _text(F.col("event_id") % 200)).alias("has_id"),
            _text(F.col("event_id") % 4).alias("state"), F.col("ts").alias("event_time"),
            F.col("event_id").alias("seq"))

    @cached_property
    def play_request(self) -> DataFrame:
        lines = self._of_lines("l_linenumber", "l_quantity", "l_discount", "l_extendedprice", "l_returnflag",
                               "l_shipdate")
        quantity = F.col("l_quantity").cast("bigint")
        number = F.col("l_linenumber")
        factor = F.col("o_custkey") % 4
        freeze = F.floor(F.col("l_discount") * 100 + 0.5).cast("bigint") * factor * factor * factor * 30000
        return lines.select(
            F.concat("probe_id", F.lit("s"), _text(F.col("l_orderkey"))).alias("has_id"), "probe_id",
            F.when(number == 7, "2").otherwise(F.col("province_id")).alias("province_id"),
            F.when(number == 7, "0").otherwise(F.col("city_id")).alias("city_id"),
            "platform", "device_provider", "fw_version",
            _text(F.col("l_orderkey") % 9 + 1).alias("has_type"),
            (quantity * 60).alias("play_seconds"), number.cast("bigint").alias("freeze_count"),
            F.when(F.col("l_returnflag") == "N", 0).otherwise(freeze).cast("bigint").alias("freeze_time"),
            ((quantity - 1) * 1100000).alias("latency"),
            F.floor("l_extendedprice").cast("bigint").alias("down_bytes"),
            F.when(F.col("l_quantity") == 1, 0).otherwise(quantity).cast("bigint").alias("down_seconds"),
            self._line_time().alias("event_time"),
            (F.col("l_orderkey") * 8 + number).alias("seq"))

    @staticmethod
    def _line_time() -> Column:
        return F.expr("l_shipdate + l_linenumber * interval '1' minute")

    @cached_property
    def lag(self) -> DataFrame:
        clicks = self._of_events().where("event_type = 'click'").select(
            F.concat(F.lit("h"), _text(F.col("event_id") % 200)).alias("has_id"), *AREA,
            _text(F.col("event_id") % 17 + 1).alias("export_id"), F.col("ts").alias("event_time"), "event_id")
        first = clicks.withColumn("seq", F.col("event_id"))
        again = (clicks.where("event_id % 5 = 0").withColumn("export_id", F.lit("1"))
                 .withColumn("seq", F.col("event_id") + 10000000))
        return first.unionByName(again).drop("event_id")

    @cached_property
    def play_fail(self) -> DataFrame:
        moved = F.col("event_id") % 11 == 0
        return self._of_events().where("event_type = 'error'").select(
            "probe_id", F.when(moved, "2").otherwise(F.col("province_id")).alias("province_id"),
            F.when(moved, "0").otherwise(F.col("city_id")).alias("city_id"), "platform", "device_provider",
            "fw_version", _text(F.col("event_id") % 9 + 1).alias("has_type"),
            _text(400 + F.col("event_id") % 5).alias("status_code"), F.col("ts").alias("event_time"),
            F.col("event_id").alias("seq"))

    @cached_property
    def play(self) -> DataFrame:
        return self._of_events().select(
            F.concat(F.lit("h"), _text(F.col("event_id"))).alias("has_id"), *AREA,
            _text(F.col("event_id") % 9 + 1).alias("has_type"), F.col("ts").alias("event_time"))

    @cached_property
    def epg(self) -> DataFrame:
        lines = self._of_lines("l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
        quantity = F.col("l_quantity").cast("bigint")
        return lines.select(
            *AREA, _text(F.col("l_linenumber") % 3 + 1).alias("page_type"), quantity.alias("requests"),
            (F.floor("l_extendedprice").cast("bigint") * 30).alias("http_rsp_time"),
            (quantity - F.col("l_linenumber") % 2).alias("page_suc_cnt"), self._line_time().alias("event_time"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))

    @cached_property
    def image(self) -> DataFrame:
        lines = self._of_lines("l_linenumber", "l_quantity", "l_shipdate")
        quantity = F.col("l_quantity").cast("bigint")
        return lines.select(
            *AREA, (quantity - 1).alias("requests"), F.greatest(quantity - 2, F.lit(0)).alias("suc_cnt"),
            F.greatest(quantity - 5, F.lit(0)).alias("le3s_cnt"), self._line_time().alias("event_time"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))

    @cached_property
    def login(self) -> DataFrame:
        pages = F.col("o_orderkey") % 5
        return self._of_orders("o_orderdate").select(
            *AREA, pages.alias("pages"), F.greatest(pages - 1, F.lit(0)).alias("suc_pages"),
            F.col("o_orderdate").alias("event_time"), F.col("o_orderkey").alias("seq"))

    @cached_property
    def http_error(self) -> DataFrame:
        lines = self._of_lines("l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
        return lines.select(
            *AREA, _text(400 + F.col("l_partkey") % 6).alias("http_rsp_code"),
            F.col("l_quantity").cast("bigint").alias("cnt"), self._line_time().alias("event_time"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))

    @cached_property
    def event(self) -> DataFrame:
        return self._of_events().select(
            *AREA, _text(F.col("event_id") % 16 + 1).alias("event_id"),
            F.floor("value").cast("bigint").alias("cnt"), F.col("ts").alias("event_time"),
            F.col("event_id").alias("seq"))

    def records(self, log: str) -> DataFrame:
        """Typed rows of a log with a running number ``seq``."""
        if log == "terminal_info":
            return self._boxes().withColumnRenamed("_key", "seq")
        return getattr(self, log)

    def raw_lines(self, log: str) -> DataFrame:
        """Delimited lines of a log, a fixed share of them damaged: type, length, blank field, bad measure."""
        return raw_lines(self.records(log), log)


#: width of a raw line, the field blanked and the field made non-numeric by the damage rule (None: no such field)
RAW = {
    "terminal_info": (17, None, None), "state": (7, None, None), "play_request": (41, 16, 12),
    "lag": (16, None, None), "play_fail": (14, None, None), "epg": (16, 8, 11), "image": (14, 12, 10),
    "login": (14, 2, 9), "http_error": (14, 4, 13), "event": (16, 5, 13),
}


def raw_lines(records: DataFrame, log: str) -> DataFrame:
    layout = LOGS[log]
    width, blank_at, number_at = RAW[log]
    parts: list[Column] = [F.lit("") for _ in range(width)]
    parts[0] = F.when(F.col("seq") % 13 == 0, "99").otherwise(layout.code)
    for name, (position, _) in layout.fields.items():
        if name == "session_part":
            parts[position] = F.concat(F.lit("s"), F.regexp_extract("has_id", "s([0-9]+)$", 1))
        elif name in records.columns:
            own = stamp(F.col(name)) if name == "event_time" else _text(F.col(name))
            parts[position] = F.coalesce(own, F.lit(""))
    if log == "event":
        parts[1], parts[9] = F.lit("k"), F.lit("n")
        parts[11] = F.lit("u")
    if blank_at is not None:
        parts[blank_at] = F.when(F.col("seq") % 19 == 0, " ").otherwise(parts[blank_at])
    if number_at is not None:
        parts[number_at] = F.when(F.col("seq") % 23 == 0, "x").otherwise(parts[number_at])
    line = F.concat_ws(DELIMITER, *parts)
    return records.select("seq", F.when(F.col("seq") % 17 == 0, parts[0]).otherwise(line).alias("value"))


def write_sequence_files(lines: DataFrame, path: str) -> None:
    """Lines as SequenceFile values, as collectors hand them over."""
    lines.select("value").rdd.map(lambda row: (None, bytearray(row[0], "utf-8"))).saveAsSequenceFile(path)
