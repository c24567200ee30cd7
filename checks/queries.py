"""The registered queries: name -> (Spark callable, SQL text or None).

Names end in the inventory id they cover.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql as q
from offerwise.functions import scalars as sc
from offerwise.functions.stats import cumulative, clean, moments
from offerwise.operators import campaigns, coupons, cubes, customers, grids, joins, offers, ordering, profile, trajectories
from offerwise.plans import customer_table as ct
from offerwise.plans import model
from offerwise.plans import training_table as tt
from offerwise.sources import tables
from offerwise.sources.retail import CAMPAIGNS, CATEGORIES, REF_YEAR, RetailTables
from offerwise.sources.staging import new_path, stage

C = F.col
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and doubles to six digits, as in the SQL texts."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c + F.lit(q.OFF_HALF), 6) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint", "boolean"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


def register(name: str, text: str | None = None):
    def add(build: Callable[[RetailTables], DataFrame]):
        REGISTRY[name] = (lambda spark, folder: tidy(build(RetailTables(spark, folder))), text)
        return build

    return add


def sql(columns: list[str], source: str, *ctes: str) -> str:
    return q.query(ctes, columns, source)


ints, dbls, strs = q.ints, q.dbls, q.strs
LINE_KEYS = ("customer_id", "item_id", "order_id", "line_no")
OFFER_COLS = ("id", "campaign_id", "coupon_id", "customer_id")

# Sources and sinks --------------------------------------------------------------------------

COUPON_PROB = """coupon_prob as (select coupon_id, avg(redemption_status) as p from impression where train_set = 1 group by coupon_id)"""


@register("csv_scan__S1", sql(ints(*OFFER_COLS, "redemption_status"), "impression where train_set = 1"))
def _(r):
    path = new_path(r.spark, "train-csv")
    train = r.offers.where(C("train_set") == 1).select(*OFFER_COLS, "redemption_status")
    train.write.option("header", True).csv(path)
    return tables.read_table(r.spark, path, "train")


def _coupon_cube(r):
    return coupons.coupon_cube(coupons.add_items(r.coupon_item, r.item))


def _coupon_prob(r):
    return r.offers.where(C("train_set") == 1).groupBy("coupon_id").agg(F.avg("redemption_status").alias("redemption_status"))


@register(
    "score_sink__S2",
    sql(ints("id") + dbls("redemption_status"), "(select id, p as redemption_status from impression left join coupon_prob using (coupon_id) where train_set = 0)", COUPON_PROB),
)
def _(r):
    path = new_path(r.spark, "scores-csv")
    unlabelled = r.offers.where(C("train_set") == 0).drop("redemption_status")
    tables.write_scores(joins.lookup(unlabelled, _coupon_prob(r), ["coupon_id"]), path)
    return tables.read_table(r.spark, path, "submission")


IMPORTANCE = """item_gain as (
  select category_label as feature, count(*) as split, 100 * sum(selling_price) / sum(sum(selling_price)) over () as gain
  from raw_line group by category_label)"""


@register("importance_sink__S3", sql(strs("feature") + ints("split") + dbls("gain"), "item_gain", IMPORTANCE))
def _(r):
    path = new_path(r.spark, "importance-csv")
    sold = joins.lookup(r.transactions, r.item, ["item_id"]).groupBy(C("category").alias("feature")).agg(
        F.count("*").alias("split"), F.sum("selling_price").alias("_s"), F.lit(1).alias("_one")
    )
    total = sold.agg(F.sum("_s").alias("_t"), F.lit(1).alias("_one"))
    tables.write_importance(
        joins.lookup(sold, total, ["_one"]).withColumn("gain", C("_s") / C("_t") * 100), path
    )
    return tables.read_table(r.spark, path, "importance")


# Profiling ----------------------------------------------------------------------------------

PROFILED = (
    "date", "customer_id", "item_id", "quantity", "selling_price", "other_discount", "coupon_discount", "order_id",
    "line_no", "store_id", "brand", "brand_type", "category", "t_yr", "t_mon", "t_wk", "t_d", "t_dwk", "YMon", "Yday",
    "other_yes", "coup_yes", "sp_qty", "other_dis_qty", "coup_dis_qty", "tot_dis_qty", "pp_qty", "cdis_p", "dis_p",
)
NULLS = " union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as nulls from line" for c in PROFILED)


@register("null_counts__PR1", sql(strs("column") + ints("nulls"), f"({NULLS})"))
def _(r):
    return profile.null_counts(r.lines.select(*PROFILED))


@register("value_counts__PR2", sql(strs("category") + ints("count"), '(select category_label as category, count(*) as "count" from raw_line group by 1)'))
def _(r):
    return profile.value_counts(joins.lookup(r.transactions, r.item, ["item_id"]), "category")


VALUES = " union all ".join(
    f'select \'{c}\' as "column", cast({c} as varchar) as "value", count(*) as "count" from ci where {c} is not null group by {c}'
    for c in ("coupon_id", "item_id", "brand", "brand_type", "category")
)


@register("value_counts_all__PR2", sql(strs("column", "value") + ints("count"), f"({VALUES})"))
def _(r):
    return profile.value_counts_all(coupons.add_items(r.coupon_item, r.item))


TYPES = " union all ".join(
    f"select {i} as position, '{c}' as \"column\", '{t}' as dtype, count(*) - count({c}) as nulls from impression"
    for i, (c, t) in enumerate(
        [("id", "bigint"), ("campaign_id", "int"), ("coupon_id", "bigint"), ("customer_id", "bigint"), ("train_set", "int"), ("redemption_status", "int")]
    )
)


@register("describe_columns__PR3", sql(ints("position", "nulls") + strs("column", "dtype"), f"({TYPES})"))
def _(r):
    return profile.describe_columns(r.offers)


HEAD_COLS = ("customer_id", "item_id", "order_id", "line_no", "coup_yes")
HEAD = "customer_id desc, date desc, item_id, order_id, line_no, store_id, quantity, selling_price"


@register(
    "sample_head__PR4_O4",
    sql(ints(*HEAD_COLS) + dbls("sp_qty"), f"(select * from line order by {HEAD} limit 1000)"),
)
def _(r):
    order = [F.desc("customer_id"), F.desc("date"), "item_id", "order_id", "line_no", "store_id", "quantity", "selling_price"]
    return profile.sample_head(r.lines, 1000, order).select(*HEAD_COLS, "sp_qty")


@register(
    "shape__PR5",
    sql(strs("part") + ints("n_rows", "n_columns"), "(select case when train_set = 1 then 'train' else 'test' end as part, count(*) as n_rows, 6 as n_columns from impression group by 1)"),
)
def _(r):
    train, test = offers.split(r.offers)
    return profile.shape(train).withColumn("part", F.lit("train")).unionByName(
        profile.shape(test).withColumn("part", F.lit("test"))
    )


# Projections --------------------------------------------------------------------------------

ORDER_DAY = "(select o_orderkey as order_id, cast(o_orderdate as date) as day from orders)"


@register("iso_date__P1", sql(ints("order_id") + strs("day"), ORDER_DAY))
def _(r):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return r.table("orders").select(C("o_orderkey").alias("order_id"), sc.parse_date(text).alias("day"))


@register("short_date__P2", sql(ints("order_id") + strs("day"), ORDER_DAY))
def _(r):
    text = F.date_format("o_orderdate", "dd/MM/yy")
    return r.table("orders").select(C("o_orderkey").alias("order_id"), sc.parse_date(text, "dd/MM/yy").alias("day"))


@register("date_parts__P3a", sql(ints(*LINE_KEYS, "t_yr", "t_mon", "t_wk", "t_d", "t_dwk"), "line"))
def _(r):
    return r.transactions.select(*LINE_KEYS, *[c.alias(n) for n, c in sc.date_parts(C("date"), "t").items()])


@register("campaign_date_parts__P3b", sql(ints("id", *q.CAMPAIGN_INTS[1:11]), "offer0", q.OFFER))
def _(r):
    return offers.add_campaign(r.offers, r.campaign).select("id", *q.CAMPAIGN_INTS[1:11])


@register(
    "period_keys__P4",
    sql(
        ints(*LINE_KEYS, "YMon", "Yday", "s_YMon", "s_Yday", "e_YMon", "e_Yday"),
        """(select *, year(start_date) * 100 + month(start_date) as s_YMon, year(start_date) * 100 + dayofyear(start_date) as s_Yday,
            year(end_date) * 100 + month(end_date) as e_YMon, year(end_date) * 100 + dayofyear(end_date) as e_Yday from w)""",
    ),
)
def _(r):
    w = campaigns.campaign_window_join(r.lines, r.campaign, ("campaign_type", "start_date", "end_date"))
    return campaigns.campaign_columns(w, "year", periods=True).select(
        *LINE_KEYS, "YMon", "Yday", "s_YMon", "s_Yday", "e_YMon", "e_Yday"
    )


@register("used_flags__P5", sql(ints(*LINE_KEYS, "other_yes", "coup_yes"), "line"))
def _(r):
    return r.lines.select(*LINE_KEYS, "other_yes", "coup_yes")


@register("label_codes__P6", sql(ints(*LINE_KEYS, "category", "brand_type", "campaign_type"), "w"))
def _(r):
    return r.windowed.select(*LINE_KEYS, "category", "brand_type", "campaign_type")


UNIT = ("sp_qty", "other_dis_qty", "coup_dis_qty", "tot_dis_qty", "pp_qty", "dis_p", "cdis_p")


@register("unit_prices__P7", sql(ints(*LINE_KEYS) + dbls(*UNIT), "line"))
def _(r):
    return sc.unit_prices(r.transactions).select(*LINE_KEYS, *UNIT)


@register(
    "finite__P8",
    sql(ints(*LINE_KEYS) + dbls("share", "markup"), "(select *, coupon_discount / nullif(other_discount, 0) as share, other_discount / nullif(coupon_discount, 0) as markup from txn)"),
)
def _(r):
    # Plain division raises on zero in Spark, so the non-finite results are written out first.
    inf = F.lit(float("inf"))
    share = F.when(C("other_discount") == 0, F.when(C("coupon_discount") == 0, F.lit(float("nan"))).otherwise(-inf)).otherwise(
        C("coupon_discount") / F.nullif("other_discount", F.lit(0.0))
    )
    markup = F.when(C("coupon_discount") == 0, inf).otherwise(C("other_discount") / F.nullif("coupon_discount", F.lit(0.0)))
    raw = r.transactions.select(*LINE_KEYS, share.alias("share"), markup.alias("markup"))
    return sc.null_nonfinite(raw)


@register("campaign_days__P9", sql(ints("id", "diff_camp_days"), "offer0", q.OFFER))
def _(r):
    return offers.add_campaign(r.offers, r.campaign).select("id", "diff_camp_days")


@register("day_ordinal__P10", sql(ints(*LINE_KEYS, "date_ord"), "line"))
def _(r):
    return r.transactions.select(*LINE_KEYS, sc.day_ordinal(C("date")).alias("date_ord"))


@register(
    "campaign_tags__P11",
    sql(ints("campaign_id", "camp_ord", "n_lines"), "(select campaign_id, camp_ord, count(*) as n_lines from w group by all)"),
)
def _(r):
    return r.windowed.groupBy("campaign_id", "camp_ord").agg(F.count("*").alias("n_lines"))


@register(
    "coupon_use_zero_filled__P12",
    sql(ints("customer_id", "n_used"), "(select customer_id, coalesce(n, 0) as n_used from (select distinct customer_id from w) left join (select customer_id, count(*) as n from w where coup_yes = 1 group by 1) using (customer_id))"),
)
def _(r):
    used = r.windowed.where(C("coup_yes") == 1).groupBy("customer_id").agg(F.count("*").alias("n"))
    base = r.windowed.select("customer_id").distinct()
    return joins.attach(base, used, ["customer_id"]).select("customer_id", sc.zero_if_null(C("n")).alias("n_used"))


@register(
    "rank_labels__P13_W1",
    sql(ints(*LINE_KEYS, "camp_ord", "rn") + strs("rn_label"), "(select *, 'T_' || rn as rn_label from last10)", q.LAST),
)
def _(r):
    used = r.windowed.where(C("coup_yes") == 1)
    top = ordering.top_n_per_group(used, ["customer_id"], customers.newest_first(used), 10, label="T_")
    return top.select(*LINE_KEYS, "camp_ord", "rn", "rn_label")


@register("customer_ratios__P14", sql(ints("customer_id") + dbls(*q.RATIOS), "ratios", q.SUMMARY, q.RATIO_CTE))
def _(r):
    return customers.customer_summary(r.windowed, cubes.item_cube(r.windowed)).select("customer_id", *q.RATIOS)


@register(
    "select_rename_drop__P15",
    sql(ints("customer_id", "product") + dbls("price"), "(select customer_id, item_id as product, selling_price as price from txn)"),
)
def _(r):
    narrow = r.transactions.withColumnsRenamed({"item_id": "product", "selling_price": "price"})
    return narrow.drop("date", "quantity", "other_discount", "coupon_discount", "order_id", "line_no", "store_id")


@register("to_number__P16", sql(ints("id", "customer_id"), "impression"))
def _(r):
    return r.offers.select("id", sc.to_number(C("customer_id").cast("string")).alias("customer_id"))


ONE_HOT = [f"category_{x}" for x in CATEGORIES] + ["brand_type_Established", "brand_type_Local"]


@register(
    "one_hot__P17",
    sql(
        ints("coupon_id", "item_id", *ONE_HOT),
        "(select coupon_id, item_id, "
        + ", ".join(f"case when category = '{x}' then 1 else 0 end as category_{x}" for x in CATEGORIES)
        + ", "
        + ", ".join(f"case when brand_type = '{x}' then 1 else 0 end as brand_type_{x}" for x in q.BRAND_TYPES)
        + " from ci)",
    ),
)
def _(r):
    new = sc.one_hot(C("category"), CATEGORIES, "category_") | sc.one_hot(C("brand_type"), q.BRAND_TYPES, "brand_type_")
    return coupons.add_items(r.coupon_item, r.item).select("coupon_id", "item_id", *[c.alias(n) for n, c in new.items()])


def _order_cells(r):
    """Lines per customer and campaign as long cells."""
    return r.windowed.groupBy("customer_id", "camp_ord").agg(F.sum("quantity").alias("v"))


QTY_CELLS = "qty_cells as (select customer_id, camp_ord as k, sum(quantity) as v from w group by all)"


def _row_stats(r, form):
    sums = _order_cells(r).groupBy("customer_id").agg(*moments(C("v"), "x"))
    return sums.select("customer_id", *[c.alias(f"qty_{s}") for s, c in form("x").items()])


@register("row_stats_cumulative__P19a", sql(ints("customer_id") + dbls(*q.four("qty")), "qs", QTY_CELLS, q.row_stats("qs", "qty_cells", "v", "qty")))
def _(r):
    return _row_stats(r, cumulative)


@register("row_stats_clean__P19b", sql(ints("customer_id") + dbls(*q.four("qty")), "qs", QTY_CELLS, q.row_stats("qs", "qty_cells", "v", "qty", "clean")))
def _(r):
    return _row_stats(r, clean)


@register(
    "last_distinct__P20",
    sql(ints("customer_id", *q.LAST_UNIQUE), "u_I_uniq join u_B_uniq using (customer_id) join u_C_uniq using (customer_id)", q.LAST, *[q.unique_cte(u) for u in q.LAST_UNIQUE]),
)
def _(r):
    return customers.last_purchases(r.windowed, diffs=(), levels=())


CELL_DIFF = q.dense("qg", "qty_cells", "null")


@register("cell_diff__P21", sql(ints("customer_id") + dbls(*q.four("step")), "qs", QTY_CELLS, *CELL_DIFF, q.row_stats("qs", "qg", "d", "step")))
def _(r):
    cells = grids.melt(_order_cells(r), {"qty": C("v")}, C("camp_ord").cast("bigint"))
    return grids.widen(grids.trajectory_stats(cells, {"qty": grids.VALUE}), [grids.Family("step", "qty", "diff")])


@register(
    "grid_ratio__P22",
    sql(ints("customer_id", "camp_ord") + dbls("share"), "(select customer_id, camp_ord, sum(coup_yes) * 1.0 / nullif(count(*), 0) as share from w group by all)"),
)
def _(r):
    keys = ["customer_id", "camp_ord"]
    count = lambda d: d.groupBy(*keys).agg(F.count("*").cast("double").alias("v"))
    return grids.grid_ratio(count(r.windowed.where(C("coup_yes") == 1)), count(r.windowed), keys, "share")


# Filters ------------------------------------------------------------------------------------


@register("in_window__F1", sql(ints(*LINE_KEYS), "txn where date between date '1997-03-01' and date '1997-06-30'"))
def _(r):
    first, last = (F.lit(d).cast("date") for d in ("1997-03-01", "1997-06-30"))
    return campaigns.in_window(r.transactions, "date", first, last).select(*LINE_KEYS)


@register(
    "equality_filters__F2",
    sql(ints("customer_id", "n_coupon", "n_type", "n_brand", "n_category"),
        """(select customer_id, count(*) filter (where coup_yes = 1) as n_coupon, count(*) filter (where campaign_type = 0) as n_type,
            count(*) filter (where brand_type = 1) as n_brand, count(*) filter (where category = 3) as n_category from w group by 1)"""),
)
def _(r):
    return r.windowed.groupBy("customer_id").agg(
        F.count_if(C("coup_yes") == 1).alias("n_coupon"),
        F.count_if(C("campaign_type") == 0).alias("n_type"),
        F.count_if(C("brand_type") == 1).alias("n_brand"),
        F.count_if(C("category") == 3).alias("n_category"),
    )


@register("year_and_coupon__F3", sql(ints(*LINE_KEYS, "camp_ord"), "w where t_yr = 2000 and coup_yes = 1"))
def _(r):
    return r.windowed.where((C("t_yr") == 2000) & (C("coup_yes") == 1)).select(*LINE_KEYS, "camp_ord")


@register(
    "split_unlabelled__F4",
    sql(ints(*q.OFFER_KEYS) + strs("part"), "(select *, case when train_set = 1 then 'train' else 'test' end as part from impression)"),
)
def _(r):
    train, test = offers.split(r.offers)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# Joins --------------------------------------------------------------------------------------


@register(
    "dimension_join__J1",
    sql(ints(*LINE_KEYS) + strs("brand", "brand_type", "category"), "(select t.*, brand, brand_type, category from txn t left join item using (item_id))"),
)
def _(r):
    return joins.lookup(r.transactions, r.item, ["item_id"]).select(*LINE_KEYS, "brand", "brand_type", "category")


@register(
    "customer_assembly__J2",
    sql(ints("customer_id", *q.USED_INTS, *q.RECENCY_INTS, "TDiff_min", "TDiff_max") + dbls("TDiff_mean", "TDiff_std"),
        "(select distinct customer_id from w) left join used using (customer_id) left join recent using (customer_id) left join tdiff using (customer_id)",
        q.USED, q.recency_cte(), q.LAST_DAYS, q.row_stats("tdiff", "day_gaps", "d", "TDiff", "clean")),
)
def _(r):
    day, item = cubes.day_cube(r.lines, r.campaign_codes), cubes.item_cube(r.windowed)
    used = customers.variety_summary(customers.value_table(item)).select("customer_id", *q.USED_INTS)
    parts = [customers.recency(day, REF_YEAR), customers.last_days(day)]
    return reduce(lambda a, b: joins.attach(a, b, ["customer_id"]), parts, used)


@register(
    "attach_aggregate__J3_J6",
    sql(ints(*LINE_KEYS, "n_lines") + dbls("avg_price"), "(select t.*, n_lines, avg_price from txn t left join (select customer_id, count(*) as n_lines, avg(selling_price) as avg_price from txn group by 1) using (customer_id))"),
)
def _(r):
    per_customer = r.transactions.groupBy("customer_id").agg(
        F.count("*").alias("n_lines"), F.avg("selling_price").alias("avg_price")
    )
    return joins.attach(r.transactions, per_customer, ["customer_id"]).select(*LINE_KEYS, "n_lines", "avg_price")


@register(
    "assemble__J4",
    sql(ints("id", *q.COUPON_SUM_INTS, "total_trans", "total_coup_used"), "impression left join coupon_sum using (coupon_id) left join summary using (customer_id)", q.COUPON_SUMMARY, q.SUMMARY),
)
def _(r):
    coupon = coupons.coupon_summary(_coupon_cube(r))
    customer = customers.spending_summary(r.windowed).select("customer_id", "total_trans", "total_coup_used")
    return tt.assemble(r.offers, coupon, customer).select("id", *q.COUPON_SUM_INTS, "total_trans", "total_coup_used")


@register("campaign_window_join__J5", sql(ints(*LINE_KEYS, "campaign_id", "camp_ord", "campaign_type"), "w"))
def _(r):
    return r.windowed.select(*LINE_KEYS, "campaign_id", "camp_ord", "campaign_type")


@register("campaign_window_join_shuffled__J5", REGISTRY["campaign_window_join__J5"][1])
def _(r):
    # The way taken when the calendar is too large to broadcast.
    w = campaigns.campaign_window_join(r.lines, r.campaign_codes, max_rows=0)
    return w.select(*LINE_KEYS, "campaign_id", "camp_ord", "campaign_type")


@register(
    "grid_alignment__J7",
    sql(ints("customer_id", "camp_ord") + dbls("price_ratio"),
        """(select a.customer_id, a.camp_ord, coalesce(b.v, 0) / nullif(a.v, 0) as price_ratio
            from (select customer_id, camp_ord, sum(selling_price) as v from w group by all) a
            left join (select customer_id, camp_ord, sum(selling_price) as v from w where coup_yes = 1 group by all) b
            on a.customer_id = b.customer_id and a.camp_ord = b.camp_ord)"""),
)
def _(r):
    keys = ["customer_id", "camp_ord"]
    total = lambda d: d.groupBy(*keys).agg(F.sum("selling_price").alias("v"))
    return grids.grid_ratio(total(r.windowed.where(C("coup_yes") == 1)), total(r.windowed), keys, "price_ratio")


# Aggregations -------------------------------------------------------------------------------


@register("customer_summary__A1", sql(ints("customer_id", *q.SUMMARY_INTS) + dbls(*q.SUMMARY_DBLS), "summary", q.SUMMARY))
def _(r):
    table = customers.customer_summary(r.windowed, cubes.item_cube(r.windowed))
    return table.drop(*q.RATIOS, *q.USED_INTS)


@register("customer_summary_pooled__A1", sql(ints("customer_id", *q.SUMMARY_INTS) + dbls(*q.SUMMARY_DBLS), "summary", q.SUMMARY))
def _(r):
    """The form the customer table uses: from the cubes."""
    day = stage(cubes.day_cube(r.lines, r.campaign_codes), "day-cube")
    item = stage(cubes.item_cube(r.windowed), "item-cube")
    pooled = customers.pooled_summary(stage(cubes.spend_cube(r.windowed), "spend-cube"), day)
    table = pooled.join(customers.variety_summary(customers.value_table(item)), "customer_id", "left")
    return table.select("customer_id", *q.SUMMARY_INTS, *q.SUMMARY_DBLS)


@register("sample_std__A2", sql(ints("customer_id", "camp_ord") + dbls("sp_qty_std"), "(select customer_id, camp_ord, stddev_samp(sp_qty) as sp_qty_std from w group by all)"))
def _(r):
    return cubes.price_cube(r.windowed, {"sp_qty_std": ("sp_qty", "std")})


@register("coupon_variety__A3", sql(ints("customer_id", *q.USED_INTS), "used", q.USED))
def _(r):
    return customers.variety_summary(customers.value_table(cubes.item_cube(r.windowed))).select("customer_id", *q.USED_INTS)


@register("count_per_group__A4", sql(ints("campaign_id", "camp_id_count"), "(select campaign_id, count(id) as camp_id_count from impression group by 1)"))
def _(r):
    return r.offers.groupBy("campaign_id").agg(F.count("id").alias("camp_id_count"))


@register("one_hot_sums__A5", sql(ints("coupon_id", *q.COUPON_BREADTH_INTS), "coupon_breadth", q.COUPON_BREADTH))
def _(r):
    return coupons.coupon_breadth(_coupon_cube(r), CATEGORIES)


@register("recency__A6", sql(ints("customer_id", *q.RECENCY_INTS), "recent", q.recency_cte()))
def _(r):
    return customers.recency(r.windowed, REF_YEAR)


def _mode_sql(columns):
    ctes, names = zip(*[q.mode_cte(c, coupon) for c in columns for coupon in (False, True)])
    source = "(select distinct customer_id from w)" + "".join(f" left join m_{n} using (customer_id)" for n in names)
    text = [n for n in names if n.startswith("MCbrand")]
    return sql(ints("customer_id", *[n for n in names if n not in text]) + strs(*text), source, *ctes)


@register("usual_items__A7a", _mode_sql(q.MODES[:3]))
def _(r):
    return customers.item_modes(cubes.item_cube(r.windowed))


@register("usual_days__A7a", _mode_sql(q.MODES[3:]))
def _(r):
    return customers.day_modes(cubes.day_cube(r.lines, r.campaign_codes))


@register("usual_month_from_lines__A7a", _mode_sql(["YMon"]).replace(', cast("MCYMondis" as bigint) as "MCYMondis"', ""))
def _(r):
    order = [F.negative(F.unix_date("date")), *[C(c) for c in ("camp_ord", "item_id", "order_id", "line_no")]]
    return customers.mode_per_group(r.windowed, ["customer_id"], "YMon", order, "MCYMon")


@register("usual_coupon_items__A7b_C2", sql(ints("coupon_id", *q.COUPON_MODE_INTS) + strs("MCCoupbrand", "MCCoupcategory_c"), "coupon_modes", *q.COUPON_MODES))
def _(r):
    return coupons.coupon_mode(_coupon_cube(r), CATEGORIES)


SLOTS = range(1, CAMPAIGNS + 1)


@register(
    "count_grid__A8",
    sql(ints("customer_id", *[f"{k}_cnt" for k in SLOTS]), "(select customer_id, " + ", ".join(f'count(*) filter (where camp_ord = {k}) as "{k}_cnt"' for k in SLOTS) + " from w group by 1)"),
)
def _(r):
    return grids.count_grid(cubes.count_cells(cubes.day_cube(r.lines, r.campaign_codes), "camp_ord"), SLOTS)


for _suffix, _grid in (("wk", "t_wk"), ("dwk", "t_dwk")):

    @register(
        f"count_cells_{_suffix}__A8",
        sql(ints("customer_id", "camp_ord", _grid, "n", "n_coup"), f"(select customer_id, camp_ord, {_grid}, count(*) as n, sum(coup_yes) as n_coup from w group by all)"),
    )
    def _(r, grid=_grid):
        return cubes.count_cells(cubes.day_cube(r.lines, r.campaign_codes), "camp_ord", grid)


@register(
    "variety_cells__A9",
    sql(ints("customer_id", "camp_ord", "n", "item_uniq", "brand_uniq"), "(select customer_id, camp_ord, count(*) as n, count(distinct item_id) as item_uniq, count(distinct brand) as brand_uniq from w group by all)"),
)
def _(r):
    return cubes.variety_cells(cubes.item_cube(r.windowed))


@register(
    "mean_cells__A10",
    sql(ints("customer_id", "camp_ord") + dbls("sp_qty_mean", "coup_dis_qty_mean", "coup_yes_mean"), "(select customer_id, camp_ord, avg(sp_qty) as sp_qty_mean, avg(coup_dis_qty) as coup_dis_qty_mean, avg(coup_yes) as coup_yes_mean from w group by all)"),
)
def _(r):
    return cubes.price_cube(r.windowed, {f"{c}_mean": (c, "mean") for c in ("sp_qty", "coup_dis_qty", "coup_yes")})


@register(
    "std_cells__A11",
    sql(ints("customer_id", "camp_ord") + dbls("sp_qty_std", "coup_dis_qty_std", "cdis_p_std"), "(select customer_id, camp_ord, stddev_samp(sp_qty) as sp_qty_std, stddev_samp(coup_dis_qty) as coup_dis_qty_std, stddev_samp(cdis_p) as cdis_p_std from w group by all)"),
)
def _(r):
    return cubes.price_cube(r.windowed, {f"{c}_std": (c, "std") for c in ("sp_qty", "coup_dis_qty", "cdis_p")})


@register("category_counts__A12_C3", sql(ints("coupon_id", *q.COUPON_COUNT_INTS), "coupon_counts", q.COUPON_COUNTS))
def _(r):
    return coupons.coupon_category_counts(_coupon_cube(r), CATEGORIES)


@register("distinct_rows__A13_U3", sql(ints("customer_id", "date_ord"), "(select distinct customer_id, date_ord from w where coup_yes = 1)"))
def _(r):
    day = sc.day_ordinal(C("date")).alias("date_ord")
    return r.windowed.where(C("coup_yes") == 1).select("customer_id", day).distinct()


@register("distinct_values__A14", sql(ints("campaign_id"), "(select distinct campaign_id from impression where train_set = 1)"))
def _(r):
    return profile.distinct_values(r.offers.where(C("train_set") == 1), "campaign_id")


# Trajectories -------------------------------------------------------------------------------

FAMILY_IDS = {
    "V1": "trip_change", "V2": "coupon_share", "V3": "coupon_share_change",
    "V4": "trip_change_wk", "V5": "coupon_share_wk", "V6": "coupon_share_change_wk",
    "V7": "trip_change_dwk", "V8": "coupon_share_dwk", "V9": "coupon_share_change_dwk",
    "V10": "item_variety", "V11": "brand_variety",
    "V12": "sp_qty_mean_all", "V13": "sp_qty_mean_coupon", "V14": "sp_qty_std_all", "V15": "sp_qty_std_coupon",
    "V16": "coup_dis_qty_mean_all", "V17": "coup_dis_qty_mean_coupon",
    "V18": "coup_dis_qty_std_all", "V19": "coup_dis_qty_std_coupon",
    "V20": "cdis_p_std_all", "V21": "cdis_p_std_coupon",
    "V22": "coupon_rate_by_campaign_type", "V23": "coupon_rate_by_brand_type", "V24": "coupon_rate_by_category",
}


def _trajectory(name, **options):
    return lambda r: trajectories.campaign_trajectory(
        r.lines, r.windowed, r.campaign_codes, name, categories=CATEGORIES, **options
    )


for _id, _name in FAMILY_IDS.items():
    register(f"{_name}__{_id}", q.family_sql(_name))(_trajectory(_name))
    if _name.endswith("_coupon"):
        register(f"{_name}_filtered__{_id}", q.family_sql(_name, quirks="clean"))(_trajectory(_name, quirks="clean"))
register("sp_qty_mean_all_clean_stats__V12", q.family_sql("sp_qty_mean_all", form="clean"))(
    _trajectory("sp_qty_mean_all", stats="clean")
)


@register("segment_rate__V23", q.family_sql("coupon_rate_by_brand_type"))
def _(r):
    return trajectories.segment_rate(r.windowed, "brand_type", "TT_coup_yes_brand", (0, 1))


# Last purchases -----------------------------------------------------------------------------


def _last_sql(prefix):
    ctes, columns, source = q.join_parts(q.last_part(prefix))
    kind = ints if prefix == "T" else dbls
    if prefix == "T":
        return sql(ints("customer_id", "TDiff_min", "TDiff_max") + dbls("TDiff_mean", "TDiff_std"), source, *ctes)
    return sql(ints("customer_id") + kind(*columns), source, *ctes)


@register("last_days__L1", _last_sql("T"))
def _(r):
    return customers.last_days(cubes.day_cube(r.lines, r.campaign_codes))


for _id, _out in (("L2", "I_uniq"), ("L3", "B_uniq"), ("L4", "C_uniq")):

    @register(f"last_{q.LAST_UNIQUE[_out]}__{_id}", sql(ints("customer_id", _out), f"u_{_out}", q.LAST, q.unique_cte(_out)))
    def _(r, out=_out):
        return customers.last_purchases(r.windowed, diffs=(), levels=(), unique=(out,))


for _id, _prefix in (("L5", "Q"), ("L6", "SP"), ("L7", "ODIS"), ("L8", "CDIS"), ("L9", "DISP")):

    @register(f"last_{q.LAST_COLUMNS[_prefix]}__{_id}", _last_sql(_prefix))
    def _(r, prefix=_prefix):
        levels = () if prefix == "Q" else (prefix,)
        return customers.last_purchases(r.windowed, diffs=(prefix,), levels=levels, unique=())


# Windows ------------------------------------------------------------------------------------

for _id, _prefix in (("W2a", "cus_str"), ("W2b", "cus_camp"), ("W2c", "cus_coup"), ("W2d", "cus_end")):

    @register(
        f"{_prefix}_shifts__{_id}",
        sql(ints("id", *q.shift_names(_prefix)), f"(select id, {q.shift_exprs(_prefix)} from offer0)", q.OFFER),
    )
    def _(r, prefix=_prefix):
        table = offers.neighbour_offers(offers.add_campaign(r.offers, r.campaign), (prefix,))
        return table.select("id", *q.shift_names(prefix))


# The same sequences with every customer above ten offers sent through the range-partitioned path.
for _id, _prefix in (("W2a", "cus_str"), ("W2c", "cus_coup")):

    @register(f"{_prefix}_shifts_split__{_id}", REGISTRY[f"{_prefix}_shifts__{_id}"][1])
    def _(r, prefix=_prefix):
        table = offers.neighbour_offers(offers.add_campaign(r.offers, r.campaign), (prefix,), hot_rows=10)
        return table.select("id", *q.shift_names(prefix))


@register("start_gaps__W3a", sql(ints("id", *q.START_GAPS), "gaps", *q.OFFER_CTES))
def _(r):
    table = offers.neighbour_offers(offers.add_campaign(r.offers, r.campaign), ("cus_str",))
    return offers.start_gaps(table).select("id", *q.START_GAPS)


@register("end_start_gaps__W3b", sql(ints("id", *q.END_GAPS), "gaps", *q.OFFER_CTES))
def _(r):
    table = offers.neighbour_offers(offers.add_campaign(r.offers, r.campaign), ("cus_str", "cus_end"))
    return offers.end_start_gaps(table).select("id", *q.END_GAPS)


@register(
    "lag_diff__W4",
    sql(ints("customer_id", "rn") + dbls("d_quantity", "d_price"), "(select customer_id, rn, d_q as d_quantity, d_sp as d_price from last10)", q.LAST),
)
def _(r):
    used = r.windowed.where(C("coup_yes") == 1)
    top = ordering.top_n_per_group(used, ["customer_id"], customers.newest_first(used), 10)
    steps = ordering.lag_diff(top, ["customer_id"], [C("rn")], {"d_quantity": "quantity", "d_price": "sp_qty"})
    return steps.select("customer_id", "rn", "d_quantity", "d_price")


@register(
    "campaign_order__W5",
    sql(ints("campaign_id", "camp_ord", "n_offers"), "(select c.campaign_id, c.camp_ord, count(*) as n_offers from impression join campaign_o c using (campaign_id) group by all)"),
)
def _(r):
    order = campaigns.campaign_order(r.campaign).select("campaign_id", "camp_ord")
    return joins.lookup(r.offers, order, ["campaign_id"]).groupBy("campaign_id", "camp_ord").agg(F.count("*").alias("n_offers"))


FOLD_CTE = """folded as (
  select *, ntile(10) over (order by customer_id, start_date_ord, coupon_id, campaign_id, id) - 1 as fold
  from offer0 where train_set = 1)"""


def _folded(r, k=10):
    train = offers.add_campaign(r.offers, r.campaign).where(C("train_set") == 1)
    return ordering.contiguous_folds(train, k, model.fold_order())


@register("contiguous_folds__W6_M2", sql(ints("id", "fold"), "folded", q.OFFER, FOLD_CTE))
def _(r):
    return _folded(r).select("id", "fold")


@register("campaign_breadth__W7", sql(ints("id", *q.BREADTH_INTS) + dbls(*q.BREADTH_DBLS), "breadth", q.OFFER, q.BREADTH))
def _(r):
    return offers.campaign_breadth(r.offers).select("id", *q.BREADTH_INTS, *q.BREADTH_DBLS)


# Order and set operations -------------------------------------------------------------------


NEWEST = sql(ints(*LINE_KEYS, "camp_ord", "rn"), "(select *, rn_all as rn from wr)")


@register("newest_first__O1", NEWEST)
def _(r):
    order = customers.newest_first(r.windowed)
    return ordering.group_positions(r.windowed, "customer_id", order, "rn").select(*LINE_KEYS, "camp_ord", "rn")


@register("newest_first_split__O1", NEWEST)
def _(r):
    order = customers.newest_first(r.windowed)
    return ordering.group_positions(r.windowed, "customer_id", order, "rn", hot_rows=60).select(*LINE_KEYS, "camp_ord", "rn")


@register(
    "offer_positions__O2",
    sql(ints("id", "position"), "(select id, row_number() over (order by customer_id, start_date_ord, coupon_id, campaign_id, id) - 1 as position from offer0)", q.OFFER),
)
def _(r):
    return ordering.global_position(offers.add_campaign(r.offers, r.campaign), model.fold_order()).select("id", "position")


@register(
    "top_items__O3",
    sql(ints("item_id") + dbls("sales"), "(select item_id, round(sum(selling_price), 2) as sales from txn group by 1 order by sales desc, item_id limit 25)"),
)
def _(r):
    sales = r.transactions.groupBy("item_id").agg(F.round(F.sum("selling_price"), 2).alias("sales"))
    return profile.top_k(sales, "sales", 25, ["item_id"])


WINDOW_LITERALS = "(select l.customer_id, l.item_id, l.order_id, l.line_no, c.camp_ord from line l join campaign_o c on l.date between c.start_date and c.end_date)"


def _windows():
    import datetime as dt

    opening = dt.date(1995, 1, 1)
    out = []
    for k in range(1, CAMPAIGNS + 1):
        first = opening + dt.timedelta((k - 1) * 85)
        out.append((k, first.isoformat(), (first + dt.timedelta(60 + (k % 4) * 40)).isoformat()))
    return out


@register("union_of_windows__U1", sql(ints(*LINE_KEYS, "camp_ord"), WINDOW_LITERALS))
def _(r):
    return campaigns.union_of_windows(r.transactions, _windows()).select(*LINE_KEYS, "camp_ord")


@register("union_train_test__U2", sql(ints(*q.OFFER_KEYS), "impression"))
def _(r):
    train, test = offers.split(r.offers)
    return offers.union_train_test(train.drop("train_set"), test.drop("train_set", "redemption_status"))


# Coupons ------------------------------------------------------------------------------------


@register("coupon_summary__C1", sql(ints("coupon_id", *q.COUPON_SUM_INTS) + dbls(*q.COUPON_SUM_DBLS), "coupon_sum", q.COUPON_SUMMARY))
def _(r):
    return coupons.coupon_summary(_coupon_cube(r))


@register("coupon_table__C4", sql(ints("coupon_id", *q.COUPON_INTS) + dbls(*q.COUPON_SUM_DBLS) + strs("MCCoupbrand", "MCCoupcategory_c"), q.COUPON_TABLE, *q.COUPON_CTES))
def _(r):
    return coupons.coupon_table(r.coupon_item, r.item, CATEGORIES)


# Whole tables -------------------------------------------------------------------------------


def _customers(r):
    return ct.customer_table(r.lines, r.campaign_codes, CATEGORIES, REF_YEAR)


@register("customer_table__E1", q.customer_table_sql())
def _(r):
    table = _customers(r)
    whole = {"TDiff_min", "TDiff_max"}
    return table.withColumns({c: C(c).cast("double") for c in whole})


@register("offer_table__E2", sql(ints(*q.OFFER_INTS) + dbls(*q.BREADTH_DBLS) + strs("start_date", "end_date"), "gaps", *q.OFFER_CTES))
def _(r):
    return offers.offer_table(r.offers, r.campaign)


def _training(r):
    return tt.training_table(
        r.offers, r.lines, r.campaign, r.campaign_codes, r.coupon_item, r.item, CATEGORIES, year=REF_YEAR
    )


def _training_parts():
    """CTEs, integer, double and text columns, and the source of the training table."""
    ctes, integers, doubles, text, source = q.customer_parts()
    code = "case MCCoupcategory_c " + " ".join(f"when '{x}' then {i}" for i, x in enumerate(CATEGORIES)) + " end"
    both = f"""(select * exclude (MCCoupcategory_c), {code} as MCCoupcategory_c from gaps left join ({q.COUPON_TABLE.join(["select * from ", ""])}) using (coupon_id)
        left join (select * from {source}) using (customer_id))"""
    integers = [*q.OFFER_INTS, *q.COUPON_INTS, "MCCoupcategory_c", *[i for i in integers if i != "customer_id"]]
    doubles = [*q.BREADTH_DBLS, *q.COUPON_SUM_DBLS, *doubles]
    return [*ctes, *q.OFFER_CTES, *q.COUPON_CTES], integers, doubles, ["MCCoupbrand", *text], both


def _training_sql(keep=lambda c: True):
    ctes, integers, doubles, text, both = _training_parts()
    text = [*text, "start_date", "end_date"]
    columns = [ints(*filter(keep, integers)), dbls(*filter(keep, doubles)), strs(*filter(keep, text))]
    return sql([c for part in columns for c in part], both, *ctes)


@register("training_table__E2", _training_sql())
def _(r):
    return _training(r).withColumns({c: C(c).cast("double") for c in ("TDiff_min", "TDiff_max")})


@register("feature_columns__P18", _training_sql(lambda c: c == "id" or c not in tt.EXCLUDED))
def _(r):
    table = _training(r).withColumns({c: C(c).cast("double") for c in ("TDiff_min", "TDiff_max")})
    return table.select("id", *tt.feature_columns(table))


# Model --------------------------------------------------------------------------------------
# The learner itself has no SQL counterpart. Its surroundings are checked on fixed scores: the share
# of lines a customer bought with coupons, shifted by fold.

SCORED = """scored as (
  select f.id, f.fold, f.redemption_status, round(coalesce(s.total_coup_used * 1.0 / s.total_trans, 0), 9) as p
  from folded f left join summary s using (customer_id))"""
SCORED_CTES = (q.OFFER, FOLD_CTE, q.SUMMARY, SCORED)


def _scored(r):
    use = customers.spending_summary(r.windowed).select(
        "customer_id", sc.ratio(C("total_coup_used").cast("double"), C("total_trans")).alias("_u")
    )
    joined = joins.attach(_folded(r), use, ["customer_id"])
    return joined.select("id", "fold", "redemption_status", F.round(F.coalesce("_u", F.lit(0.0)), 9).alias("p"))


AUC_SQL = """(select {by} sum(case when redemption_status = 1 then mid else 0 end) as ranks,
    sum(redemption_status) as pos, count(*) as n from (
      select *, rank() over ({part} order by p) + (count(*) over ({part2} p) - 1) / 2.0 as mid from scored) {group})"""


@register(
    "auc__M5",
    sql([f"round((ranks - pos * (pos + 1) / 2.0) / (pos * (n - pos)) + {q.OFF_HALF}, 6) + 0.0 as auc"], AUC_SQL.format(by="", part="", part2="partition by", group=""), *SCORED_CTES),
)
def _(r):
    return model.auc(_scored(r), "p", "redemption_status")


FOLD_AUC = "(select fold, (ranks - pos * (pos + 1) / 2.0) / (pos * (n - pos)) as auc from " + AUC_SQL.format(
    by="fold,", part="partition by fold", part2="partition by fold,", group="group by fold"
) + ")"


@register("fold_auc__M5", sql(ints("fold") + dbls("auc"), FOLD_AUC, *SCORED_CTES))
def _(r):
    return model.auc(_scored(r), "p", "redemption_status", ["fold"])


@register("cv_score__M8", sql(dbls("mean_auc") + ints("folds"), f"(select avg(auc) as mean_auc, count(auc) as folds from {FOLD_AUC})", *SCORED_CTES))
def _(r):
    return model.cv_score(model.auc(_scored(r), "p", "redemption_status", ["fold"]))


@register(
    "average_folds__M7",
    sql(ints("id") + dbls("redemption_status"), "(select i.id, avg(r.rate) as redemption_status from impression i cross join rates r where i.train_set = 0 and r.kind = i.coupon_id % 2 group by i.id)",
        q.OFFER, FOLD_CTE, "rates as (select fold, coupon_id % 2 as kind, avg(redemption_status) as rate from folded group by all)"),
)
def _(r):
    rates = _folded(r).groupBy("fold", (C("coupon_id") % 2).alias("kind")).agg(F.avg("redemption_status").alias("p"))
    test = r.offers.where(C("train_set") == 0).select("id", (C("coupon_id") % 2).alias("kind"))
    return model.average_folds(joins.lookup(test, rates, ["kind"], "inner"))


@register(
    "group_folds__M10",
    sql(ints("customer_id", "n", "n_folds", "balanced"), "(select customer_id, count(*) as n, 1 as n_folds, 1 as balanced from impression where train_set = 1 group by 1)"),
)
def _(r):
    """Folds of each customer, and whether fold sizes differ by less than twice the largest light customer."""
    folded = stage(ordering.group_folds(r.offers.where(C("train_set") == 1), "customer_id", 10), "group-folds")
    each = folded.groupBy("customer_id").agg(F.count("*").alias("n"), F.count_distinct("fold").alias("n_folds"))
    sizes = folded.groupBy("fold").agg(F.count("*").alias("size"))
    spread = sizes.agg((F.max("size") - F.min("size")).alias("spread"), F.sum("size").alias("total"))
    limit = F.floor(C("total") / (10 * ordering.HEAVY_KEYS))
    light = F.max(F.when((C("n") <= limit) | (limit == 0), C("n"))).alias("light")
    told = each.join(F.broadcast(spread)).groupBy("spread").agg(light)
    balanced = (C("spread") < 2 * F.coalesce("light", F.lit(1))).cast("bigint").alias("balanced")
    return each.join(F.broadcast(told.select(balanced)))



# Learner runs use the package's own settings on the whole training table; the matrix, the first fold's model and
# the whole run are made once for all queries of a session on a folder. Scores depend on the learner, so their SQL
# states what must hold of them.
_MADE: dict[tuple[str, str, str], object] = {}


def _made(r, what: str, make):
    key = (r.spark.sparkContext.applicationId, r.folder, what)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _matrices(r) -> model.Matrices:
    def make():
        table = _training(r)
        brands = r.item.select("brand")
        table = model.index_text(table, tt.text_features(table), brands)
        return model.matrices(table, tt.feature_columns(table))

    return _made(r, "matrices", make)


def _first_fold(r) -> model.Boosted:
    return _made(r, "first fold", lambda: model.train_fold(_matrices(r).train, 0))


def _fitted(r) -> model.Fitted:
    return _made(r, "run", lambda: model.fit(_matrices(r), done={0: _first_fold(r)}))


_CTES, _INTS, _DBLS, _TEXT, _SOURCE = _training_parts()
_WHOLE = [c for c in _INTS if c not in tt.EXCLUDED]
_FEATURES = [*_WHOLE, *[c for c in (*_DBLS, *_TEXT) if c not in tt.EXCLUDED]]
_MISSING = " + ".join(f'case when "{c}" is null then 1 else 0 end' for c in _FEATURES)
_SUM = " + ".join(f'coalesce(cast("{c}" as bigint), 0)' for c in _WHOLE)


@register(
    "feature_matrix__M1",
    sql(ints("id", "label", "fold", "n_features", "n_missing", "n_flagged", "whole"),
        f"""(select t.id, t.redemption_status as label, f.fold, {len(_FEATURES)} as n_features, {_MISSING} as n_missing,
            {_MISSING} as n_flagged, {_SUM} as whole from {_SOURCE} t join (select id as _id, fold from folded) f on f._id = t.id)""",
        *_CTES, FOLD_CTE),
)
def _(r):
    """Cells of the vectors: how many are missing by sentinel and by flag, and the exact sum of the whole numbers."""
    data = _matrices(r)
    n = len(data.features)
    places = F.array(*[F.lit(i) for i, c in enumerate(data.features) if c in set(_WHOLE)])
    cells = vector_to_array("features")
    value = lambda i: F.get(C("cells"), i)
    known = F.aggregate(
        places, F.lit(0.0), lambda a, i: a + F.when(value(i) == model.MISSING, 0.0).otherwise(value(i))
    )
    return data.train.withColumn("cells", cells).select(
        "id",
        "label",
        "fold",
        F.lit(n).alias("n_features"),
        F.size(F.filter(F.slice("cells", 1, n), lambda x: x == model.MISSING)).alias("n_missing"),
        F.size(F.filter(F.slice("cells", n + 1, max(1, len(data.flags))), lambda x: x == 1)).alias("n_flagged"),
        known.alias("whole"),
    ).withColumns({c: C(c).cast("bigint") for c in ("label", "whole")})


def _sound(p):
    return p.between(0.0, 1.0).cast("bigint").alias("sound")


@register("train_fold__M3", sql(ints("id", "fold", "sound"), "(select id, fold, 1 as sound from folded)", q.OFFER, FOLD_CTE))
def _(r):
    """The first fold's model over all labelled offers."""
    return model.score(_first_fold(r), _matrices(r).train).select("id", "fold", _sound(C("p")))


@register("score__M4", sql(ints("id", "sound"), "(select id, 1 as sound from impression where train_set = 0)"))
def _(r):
    return _fitted(r).scores.select("id", _sound(C("redemption_status")))


@register("out_of_fold__M6", sql(ints("id", "fold", "sound"), "(select id, fold, 1 as sound from folded)", q.OFFER, FOLD_CTE))
def _(r):
    return _fitted(r).held.select("id", "fold", _sound(C("p")))


@register(
    "importance__M9",
    sql(ints("fold", "n_features", "n_sound") + dbls("gain"),
        f"(select range as fold, {len(_FEATURES)} as n_features, {len(_FEATURES)} as n_sound, 100.0 as gain from range({model.FOLDS}))"),
)
def _(r):
    """Importance of every fold's model: all features, splits and gains not negative, gains of 100 percent."""
    fitted = _fitted(r)
    per_fold = model.fold_importance(fitted.models, fitted.features, r.spark, fitted.flags)
    sound = F.count_if((C("split") >= 0) & (C("gain") >= 0))
    return per_fold.groupBy("fold").agg(
        F.count_distinct("feature").alias("n_features"), sound.alias("n_sound"), F.sum("gain").alias("gain")
    )
