"""Queries over the driver's tables, one per operator or table builder.

Each takes (spark, sf_dir) and reads whole tables. Snapshots are states of a table as of a day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.functions.casts import has_fraction, lenient_bigint, lenient_double, lenient_timestamp
from strataline.functions.countries import with_country_iso
from strataline.functions.scalars import category_of, iso_day, outcome, season_of, to_day
from strataline.operators.dedupe import duplicated_rows, keep_first, keep_last
from strataline.operators.history import interval_history, merge_points
from strataline.operators.joins import asof_lookup, lookup, new_rows
from strataline.operators.prepare import conform, project_or_null
from strataline.operators.quality import (
    drift_check,
    duplicate_check,
    null_checks,
    range_checks,
    reference_check,
    roll_up,
    run_checks,
)
from strataline.operators.scd import inverted_versions, merge_type1, merge_type2
from strataline.operators.upsert import merge_statistics, newest_day, upsert
from strataline.operators.windows import offset_window
from strataline.plans.gold import performance, rolling_mean, side_performance, two_sided
from strataline.plans.silver import build_dim_date, with_effective_date
from strataline.plans.snapshots import pending
from strataline.schemas import TableSpec
from strataline.session import scratch_path
from strataline.settings import AtLeast, NotNull, QualityRules, References, Unique
from strataline.sources.fingerprint import table_digests
from strataline.workload import feed
from strataline.workload.tables import POINT, cents, load, price_points

Query = Callable[[SparkSession, str], DataFrame]


def before(column: str, day: str) -> Column:
    return F.col(column) < F.lit(day).cast("timestamp_ntz")


def since(column: str, day: str) -> Column:
    return F.col(column) >= F.lit(day).cast("timestamp_ntz")


# Marts ------------------------------------------------------------------------------------------


def season_performance(spark: SparkSession, sf: str) -> DataFrame:
    """Customer by season: distinct orders with lines, quantity and value, with customer attributes.

    Lines are summed per order before they meet the orders, on the same key, so that the join moves one
    row per order.
    """
    lines = (
        load(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(cents("l_extendedprice")).alias("value"),
        )
    )
    orders = load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), season_of(to_day("o_orderdate")).alias("season")
    )
    return performance(
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")),
        load(spark, sf, "customer"),
        key="c_custkey",
        game="o_orderkey",
        measures={"total_quantity": "quantity", "total_cents": "value"},
        attributes={"name": "c_name", "segment": "c_mktsegment", "nation": "c_nationkey"},
    )


def two_sided_results(spark: SparkSession, sf: str) -> DataFrame:
    """Each line as a contest of the supplier's nation (quantity) and the customer's (discount points).

    Seventh lines name unknown nations on the supplier's side, which take the first recorded name.
    """
    customer, supplier, orders = (load(spark, sf, t) for t in ("customer", "supplier", "orders"))
    lines = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        "l_suppkey",
        "l_linenumber",
        season_of(to_day("l_shipdate")).alias("season"),
        F.col("l_quantity").cast("bigint").alias("score_a"),
        F.round(F.col("l_discount") * 500).cast("bigint").alias("score_b"),
    )
    # Who ordered is settled once per order, before lines are met.
    buyers = lookup(orders, customer, {"o_custkey": "c_custkey"}, {"nation_b": "c_nationkey", "name_b": "c_name"})
    unknown = F.when(F.col("l_linenumber") == 7, F.col("nation_s") + 100).otherwise(F.col("nation_s"))

    def placed(rows: DataFrame, buyers: DataFrame) -> DataFrame:
        games = lookup(rows, buyers, {"game_id": "o_orderkey"}, {"nation_b": "nation_b", "name_b": "name_b"})
        games = lookup(games, supplier, {"l_suppkey": "s_suppkey"}, {"nation_s": "s_nationkey", "name_a": "s_name"})
        return games.withColumn("nation_a", unknown)

    contests = placed(lines, buyers).select(
        "game_id", "season", "nation_a", "nation_b", "score_a", "score_b",
        F.col("name_a").isNotNull().alias("named_a"), F.col("name_b").isNotNull().alias("named_b"),
        F.col("score_a").alias("against_b"), F.col("score_b").alias("against_a"),
        outcome("score_a", "score_b").alias("result_a"), outcome("score_b", "score_a").alias("result_b"),
    )
    sides = [
        {
            "nation": f"nation_{x}", "named": f"named_{x}", "result": f"result_{x}",
            "scored": f"score_{x}", "conceded": f"against_{x}",
        }
        for x in ("a", "b")
    ]

    def recorded(winners: DataFrame) -> DataFrame:
        games = winners.select("game_id").distinct()
        few = lines.select("game_id", "l_suppkey", "l_linenumber", "season").join(games, "game_id", "left_semi")
        of_few = buyers.join(games, buyers["o_orderkey"] == games["game_id"], "left_semi")
        return two_sided(
            placed(few, of_few).select("game_id", "season", "nation_a", "nation_b", "name_a", "name_b"),
            [{"nation": f"nation_{x}", "recorded_name": f"name_{x}"} for x in ("a", "b")],
        )

    return side_performance(
        two_sided(contests, sides).dropna(subset=["nation", "season"]),
        load(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name")),
        recorded,
        key="nation",
        name="nation_name",
    )


def rolling_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Every line's price with the rolling mean of the part's last three lines by ship day."""
    points = load(spark, sf, "lineitem").select(
        "l_partkey",
        to_day("l_shipdate").alias("ship_day"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        cents("l_extendedprice").alias("price"),
    )
    order = ["ship_day", "l_orderkey", "l_linenumber", "l_suppkey", "price"]
    return offset_window(points, ["l_partkey"], order, rolling_mean("price"), preceding=2).withColumnRenamed(
        "_rolling", "rolling_price"
    )


def performance_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Performance where urgent orders have no customer, low ones no season, and customers are listed twice."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    lines = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("c_custkey"),
        F.when(F.col("o_orderpriority") != "5-LOW", season_of(to_day("o_orderdate"))).alias("season"),
        F.when(F.col("o_orderstatus") != "P", F.col("quantity")).alias("quantity"),
    )
    again = customer.withColumn("c_name", F.concat(F.lit("again "), "c_name")).withColumn("c_nationkey", F.col("c_nationkey") - 1)
    subjects = keep_first(customer.unionByName(again), ["c_custkey"], ["c_nationkey", "c_name"])
    return performance(
        rows,
        subjects,
        key="c_custkey",
        game="o_orderkey",
        measures={"total_quantity": "quantity"},
        attributes={"name": "c_name", "nation": "c_nationkey"},
    )


# Histories and versioned dimensions ---------------------------------------------------------------


def _history(points: DataFrame) -> DataFrame:
    return interval_history(points, key="part", date="day", ties=["price", "supplier"], sk="price_sk")


def price_history_scd2(spark: SparkSession, sf: str) -> DataFrame:
    """Price points of every part as versions with validity."""
    return _history(merge_points(None, price_points(load(spark, sf, "lineitem")), POINT))


def history_union_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """History known up to 1998, merged with all points shipped since 1997, rebuilt."""
    points = price_points(load(spark, sf, "lineitem"))
    known = _history(merge_points(None, points.filter(F.year("day") <= 1998), POINT))
    arriving = points.filter(F.year("day") >= 1997)
    return _history(merge_points(known.select(points.columns), arriving, POINT))


def history_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Price history where returned lines name no part; such points are left out."""
    points = price_points(load(spark, sf, "lineitem"))
    points = points.withColumn("part", F.when(F.col("flag") != "R", F.col("part")))
    return _history(merge_points(None, points, POINT))


def _latest_orders(orders: DataFrame) -> DataFrame:
    """State of each customer: the attributes of the latest order."""
    latest = keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return latest.select(
        "o_custkey",
        "o_orderpriority",
        "o_orderstatus",
        cents("o_totalprice").alias("total"),
        F.when(gone, 1).otherwise(0).alias("is_deleted"),
    )


def _merge_customers(existing: DataFrame | None, orders: DataFrame) -> DataFrame:
    as_of = orders.agg(F.max(to_day("o_orderdate"))).first()[0]
    state = with_effective_date(
        _latest_orders(orders), orders, key="o_custkey", date="o_orderdate", default=as_of, deleted="is_deleted"
    )
    return merge_type2(
        existing,
        state,
        key="o_custkey",
        compare=["o_orderpriority", "o_orderstatus"],
        sk="customer_sk",
        effective="_effective",
        deleted="is_deleted",
        order=["o_custkey"],
    )


def scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Customer versions from two snapshots of the orders: before 1998, and all."""
    orders = load(spark, sf, "orders")
    first = _merge_customers(None, orders.filter(before("o_orderdate", "1998-01-01")))
    return _merge_customers(first, orders)


def scd2_inverted(spark: SparkSession, sf: str) -> DataFrame:
    """How many price versions end before they start (several prices on one day)."""
    return inverted_versions(price_history_scd2(spark, sf))


def asof_price(spark: SparkSession, sf: str) -> DataFrame:
    """Every line with the price version of its part on its ship day, else the current one.

    The history starts in 1998, so earlier lines fall back.
    """
    lineitem = load(spark, sf, "lineitem")
    points = price_points(lineitem).filter(F.year("day") >= 1998)
    versions = _history(merge_points(None, points, POINT))
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", to_day("l_shipdate").alias("ship_day"))
    return asof_lookup(
        lines, versions, fact_key="l_partkey", fact_date="ship_day", dim_key="part", sk="price_sk"
    )


def asof_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with the customer version valid on its day, from the two-snapshot dimension.

    Orders of low priority add versions that hold from a month before to a quarter after them, over others.
    """
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", to_day("o_orderdate").alias("order_day"))
    validity = ("customer_sk", "effective_date", "end_date", "is_current")
    added = load(spark, sf, "orders").filter("o_orderpriority = '5-LOW'").select(
        "o_custkey",
        (F.col("o_orderkey") + 10**9).alias("customer_sk"),
        F.date_sub(to_day("o_orderdate"), 30).alias("effective_date"),
        F.date_add(to_day("o_orderdate"), 90).alias("end_date"),
        F.lit(False).alias("is_current"),
    )
    return asof_lookup(
        orders,
        scd2_merge(spark, sf).select("o_custkey", *validity).unionByName(added),
        fact_key="o_custkey",
        fact_date="order_day",
        dim_key="o_custkey",
        sk="customer_sk",
    )


def _customer_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(cents("o_totalprice")).alias("total"),
        F.max(to_day("o_orderdate")).alias("last_day"),
    )


def scd1_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Customer totals of the first months, overwritten by totals of all later orders; keys continue."""
    orders = load(spark, sf, "orders")
    known = merge_type1(
        None, _customer_totals(orders.filter(before("o_orderdate", "1995-07-01"))), key="o_custkey", sk="customer_sk"
    )
    arriving = _customer_totals(orders.filter(since("o_orderdate", "1995-07-01")))
    return merge_type1(known, arriving, key="o_custkey", sk="customer_sk")


def fact_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the surrogate keys of day, nation and region; orders of low priority name an unknown nation."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    nations = merge_type1(None, load(spark, sf, "nation"), key="n_nationkey", sk="nation_sk")
    regions = merge_type1(None, load(spark, sf, "region"), key="r_regionkey", sk="region_sk")
    calendar = build_dim_date([(orders, ["o_orderdate"])])
    keyed = orders.select("o_orderkey", "o_custkey", "o_orderpriority", to_day("o_orderdate").alias("order_day"))
    keyed = lookup(keyed, calendar, {"order_day": "full_date"}, {"date_sk": "date_sk"}, bounded=True)
    keyed = lookup(keyed, customer, {"o_custkey": "c_custkey"}, {"nation": "c_nationkey"})
    keyed = keyed.withColumn("nation", F.when(F.col("o_orderpriority") == "5-LOW", -1).otherwise(F.col("nation")))
    keyed = lookup(
        keyed, nations, {"nation": "n_nationkey"}, {"nation_sk": "nation_sk", "region": "n_regionkey"}
    )
    keyed = lookup(keyed, regions, {"region": "r_regionkey"}, {"region_sk": "region_sk"})
    return keyed.select(
        "o_orderkey", "order_day", season_of("order_day").alias("season"), "date_sk", "nation_sk", "region_sk"
    )


def lookup_last(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the last of their orders, which a dimension lists many times; some have none."""
    customer, orders = load(spark, sf, "customer"), load(spark, sf, "orders")
    found = lookup(
        customer,
        orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))),
        {"c_custkey": "o_custkey"},
        {"last_order": "o_orderkey", "last_priority": "o_orderpriority"},
        last_by=["o_orderdate", "o_orderkey"],
    )
    return found.select("c_custkey", "last_order", "last_priority")


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar of all order and ship days, added to the calendar of the events."""
    known = build_dim_date([(load(spark, sf, "events"), ["ts"])])
    frames = [(load(spark, sf, "orders"), ["o_orderdate"]), (load(spark, sf, "lineitem"), ["l_shipdate"])]
    return build_dim_date(frames, existing=known)


# Upserts ------------------------------------------------------------------------------------------


def _line_state(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        "l_orderkey", "l_linenumber", to_day("l_shipdate").alias("ship_day"), "l_partkey", "l_suppkey",
        cents("l_extendedprice").alias("price"), "l_returnflag",
    )


def upsert_last(spark: SparkSession, sf: str) -> DataFrame:
    """Lines shipped before 1999, upserted with lines shipped since 1998; the last row per key stays."""
    lines = _line_state(load(spark, sf, "lineitem"))
    key = ["l_orderkey", "l_linenumber"]
    known = upsert(None, lines.filter(F.year("ship_day") < 1999), key)
    return upsert(known, lines.filter(F.year("ship_day") >= 1998), key)


def merge_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of merging lines shipped since 1998 into those shipped before 1999, and the newest day."""
    lines = load(spark, sf, "lineitem")
    known, arriving = lines.filter(before("l_shipdate", "1999-01-01")), lines.filter(since("l_shipdate", "1998-01-01"))
    stats = merge_statistics(known, arriving, ["l_orderkey", "l_linenumber"], "l_shipdate", "2000-06-30")
    # Two one-row results side by side.
    both = stats.unionByName(newest_day(arriving, "l_shipdate"), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def new_natural_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Lines shipped since 1998 whose (order, line) key had not shipped before 1999."""
    lines = _line_state(load(spark, sf, "lineitem"))
    return new_rows(
        lines.filter(F.year("ship_day") < 1999),
        lines.filter(F.year("ship_day") >= 1998),
        ["l_orderkey", "l_linenumber"],
    )


# Quality ------------------------------------------------------------------------------------------


def _faulty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with missing part keys (full-return lines of 1995) and suppliers (highest tax)."""
    return (
        load(spark, sf, "lineitem")
        .withColumn("l_partkey", F.when(~((F.col("l_returnflag") == "R") & (F.year("l_shipdate") == 1995)), F.col("l_partkey")))
        .withColumn("l_suppkey", F.when(F.col("l_tax") < 0.075, F.col("l_suppkey")))
        .withColumn("quantity_text", F.when(F.col("l_quantity") == 3, "n/k").otherwise(F.col("l_quantity").cast("string")))
    )


_NULLS = NotNull("lineitem", ("l_orderkey", "l_partkey", "l_suppkey"))
_REFERENCE = References("lineitem", "l_partkey", "part", "p_partkey")
_RANGES = (AtLeast("lineitem", "quantity_text", 5), AtLeast("lineitem", "l_extendedprice", 0))
_UNIQUE = Unique("lineitem", ("l_orderkey", "l_linenumber"))
_LINE = ["l_orderkey", "l_linenumber"]


def _large_parts(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").filter("p_size > 25")


def dq_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return null_checks(_faulty_lines(spark, sf), _NULLS)


def dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that are referred to by lines but are not among the large parts."""
    return reference_check(load(spark, sf, "lineitem"), _large_parts(spark, sf), _REFERENCE)


def dq_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return range_checks(_faulty_lines(spark, sf), _RANGES, _LINE)


def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_check(load(spark, sf, "lineitem"), _UNIQUE)


def dq_duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every line that shares its (order, line) key with another."""
    return _line_state(duplicated_rows(load(spark, sf, "lineitem"), _LINE))


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """Roll-up of a whole rule set over faulty lines."""
    rules = QualityRules((_NULLS,), (_REFERENCE,), _RANGES, (_UNIQUE, Unique("orders", ("o_orderkey",))))
    tables = {
        "lineitem": _faulty_lines(spark, sf),
        "part": _large_parts(spark, sf),
        "orders": load(spark, sf, "orders"),
    }
    return roll_up(run_checks(spark, tables, rules, keys={"lineitem": _LINE}))


# Conformance and scalar functions -------------------------------------------------------------------


def schema_prepare(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a declaration that reorders, lacks the priority and adds a flag; clerk is null."""
    fields = T.StructType(
        [
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("is_deleted", T.LongType()),
        ]
    )
    ready, _ = conform(load(spark, sf, "orders"), TableSpec("orders", fields, ("o_orderkey",), {"is_deleted": 0}))
    wanted = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_clerk": "string", "o_orderstatus": "string", "is_deleted": "int"}
    return project_or_null(ready, wanted)


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift result over load metrics that orders and lineitem yield against narrower declarations."""
    rows = None
    for name, key, extra in (("orders", "o_orderkey", ["o_orderpriority"]), ("lineitem", "l_orderkey", [])):
        df = load(spark, sf, name)
        kept = T.StructType([f for f in df.schema.fields if f.name not in extra])
        _, report = conform(df, TableSpec(name, kept, (key,)))
        columns = F.array(*[F.lit(c) for c in report.extra_columns]).cast("array<string>")
        metrics = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table"), "row_count", columns.alias("extra_columns")
        )
        rows = metrics if rows is None else rows.unionByName(metrics)
    return drift_check(rows)


def lenient_casts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' numbers and days written in several spellings, read back leniently."""
    number = F.col("o_custkey").cast("string")
    day = iso_day("o_orderdate")
    by = F.col("o_orderpriority")
    texts = load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(by == "1-URGENT", F.concat(number, F.lit(".0")))
        .when(by == "2-HIGH", F.concat(F.lit(" \t"), number, F.lit(" ")))
        .when(by == "3-MEDIUM", F.concat(number, F.lit("e2")))
        .when(by == "4-NOT SPECIFIED", F.concat(number, F.lit(".5")))
        .otherwise(F.concat(number, F.lit(" items")))
        .alias("number_text"),
        F.when(F.col("o_orderstatus") == "O", day)
        .when(F.col("o_orderstatus") == "F", F.concat(day, F.lit(" 17:30:00")))
        .otherwise(F.concat(F.lit("day "), day))
        .alias("time_text"),
    )
    read = lenient_timestamp("time_text")
    return texts.select(
        "o_orderkey",
        lenient_bigint("number_text").alias("whole"),
        has_fraction("number_text").alias("fractional"),
        lenient_double("number_text").alias("number"),
        F.to_date(read).alias("day"),
        F.hour(read).alias("hour"),
    )


def taxonomy_map(spark: SparkSession, sf: str) -> DataFrame:
    """Parts by category: of the noun of their name if listed, else of their type."""
    taxonomy = {
        "fastener": ["bolt", "rod"],
        "machine": ["gear", "gizmo", "bolt"],
        "bulk": ["LARGE", "PROMO", "plate"],
        "retail": ["SMALL", "ECONOMY"],
    }
    noun = F.concat(F.lit(" "), F.substring_index("p_name", " ", -1), F.lit("\t"))
    part = load(spark, sf, "part")
    return part.select("p_partkey", category_of([noun, F.col("p_type")], taxonomy).alias("category"))


# Public nation names of the benchmark these tables follow, by nation key, with some of the feed's
# aliases and unknown spellings in place of others.
NATION_TEXT = [
    "Algeria", "Argentina", "Brazil", "Canada", "Egypt", "Ethiopia", "France", "Germany", "India", "Indonesia",
    "Iran", "Iraq", "Japan", "Jordan", "Kenya", "Morocco", "MOZ", "Peru", "cn", "Romania", "Saudi Arabia",
    "Korea, South", "Atlantis", "England", "USA",
]


def country_iso(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by ISO code of their nation's name, which is written differently per segment."""
    names = F.element_at(F.array(*[F.lit(n) for n in NATION_TEXT]), F.col("c_nationkey") + 1)
    written = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.upper(names))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("  "), names, F.lit("\t")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lower(names))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(names, F.lit("?")))
        .otherwise(names)
    )
    customers = load(spark, sf, "customer").withColumn("nation_text", written)
    coded = with_country_iso(customers, {"iso": "nation_text"})
    return coded.groupBy("iso").agg(F.count(F.lit(1)).alias("n_customers"), F.sum(cents("c_acctbal")).alias("balance"))


# Control of the incremental job ---------------------------------------------------------------------


def _monthly_hashes(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("snapshot"))
        .agg(F.concat_ws("|", F.count(F.lit(1)), F.sum(cents("o_totalprice")), F.max("o_orderkey")).alias("content"))
        .select("snapshot", F.md5("content").alias("content_hash"))
    )


def pending_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Months to process: the ledger saw all orders of early months, then only settled ones of later months."""
    orders = load(spark, sf, "orders")
    sources = _monthly_hashes(orders)
    settled = _monthly_hashes(orders.filter("o_orderstatus <> 'P'"))
    first = sources.filter("snapshot < '2000-01'").withColumn("seq", F.lit(1))
    second = settled.filter("snapshot >= '1998-01' and snapshot < '2001-01'").withColumn("seq", F.lit(2))
    return pending(sources, first.unionByName(second))


def source_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of orders and documents written as raw files in the order of their ids, in several parts."""
    root = scratch_path(spark, "fingerprint")
    orders = load(spark, sf, "orders").select(
        F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice"), iso_day("o_orderdate")).alias("line")
    )
    text = F.translate(F.coalesce("text", F.lit("")), "\r\n", "  ")
    documents = load(spark, sf, "documents").select(F.concat_ws("|", "doc_id", text).alias("line"))
    for name, lines in (("orders", orders), ("documents", documents)):
        # Without quotes a line is written as it is.
        written = lines.repartitionByRange("line").sortWithinPartitions("line").write.option("header", True)
        written.options(quote="", sep="\x01", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{name}.csv")
    return table_digests(spark, {t: f"{root}/{t}.csv" for t in ("orders", "documents", "absent")})


QUERIES: dict[str, Query] = {
    "season_performance": season_performance,
    "performance_gaps": performance_gaps,
    "two_sided_results": two_sided_results,
    "rolling_trend": rolling_trend,
    "price_history_scd2": price_history_scd2,
    "history_gaps": history_gaps,
    "history_union_rebuild": history_union_rebuild,
    "scd2_merge": scd2_merge,
    "scd2_inverted": scd2_inverted,
    "asof_lookup": asof_price,
    "asof_customer": asof_customer,
    "scd1_merge": scd1_merge,
    "fact_lookup": fact_lookup,
    "lookup_last": lookup_last,
    "dim_date": dim_date,
    "upsert_last": upsert_last,
    "merge_stats": merge_stats,
    "new_natural_keys": new_natural_keys,
    "dq_nulls": dq_nulls,
    "dq_orphans": dq_orphans,
    "dq_ranges": dq_ranges,
    "dq_duplicates": dq_duplicates,
    "dq_duplicate_rows": dq_duplicate_rows,
    "dq_report": dq_report,
    "schema_prepare": schema_prepare,
    "schema_drift": schema_drift,
    "lenient_casts": lenient_casts,
    "taxonomy_map": taxonomy_map,
    "country_iso": country_iso,
    "pending_snapshots": pending_snapshots,
    "source_fingerprint": source_fingerprint,
    "ingest_csv": feed.ingest_customers,
    "medallion_run": feed.replay_feed,
    "medallion_dim_players": feed.dim_players,
    "medallion_valuations": feed.dim_valuations,
    "medallion_fact_games": feed.fact_games,
    "medallion_fact_appearances": feed.fact_appearances,
    "medallion_club_mart": feed.club_mart,
    "medallion_trend_mart": feed.trend_mart,
    "medallion_cumulative": feed.cumulative,
    "medallion_ledger": feed.ledger,
    "medallion_metrics": feed.load_metrics,
    "medallion_quality": feed.quality_report,
}
