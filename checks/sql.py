"""SQL texts that compute the same results as the registered queries, written independently.

The grids are filled in densely here and row statistics run over explicit lists, where the Spark
side uses sparse cells and closed forms.
"""

from __future__ import annotations

from collections.abc import Iterable

BASE = """
campaign as (
  select cast(case when k <= 13 then k else k + 2 end as int) as campaign_id,
         case when k % 2 = 0 then 'X' else 'Y' end as campaign_type,
         date '1995-01-01' + cast((k - 1) * 85 as int) as start_date,
         date '1995-01-01' + cast((k - 1) * 85 + 60 + (k % 4) * 40 as int) as end_date
  from range(1, 29) as t(k)),
campaign_o as (
  select *, cast(row_number() over (order by start_date, campaign_id) as int) as camp_ord from campaign),
item as (
  select p_partkey as item_id, p_brand as brand,
         case when p_size % 4 = 0 then 'Local' else 'Established' end as brand_type,
         p_type as category from part),
txn as (
  select cast(o_orderdate as date) as date, o_custkey as customer_id, l_partkey as item_id,
         l_quantity as quantity, l_extendedprice as selling_price,
         -(l_extendedprice * l_tax) + 0.0 as other_discount,
         case when l_returnflag = 'R' and l_linestatus = 'F'
              then -(l_extendedprice * l_discount) + 0.0 else 0.0 end as coupon_discount,
         l_orderkey as order_id, l_linenumber as line_no, l_suppkey as store_id
  from lineitem join orders on l_orderkey = o_orderkey),
coupon_item as (
  select coupon_id, item_id from (
    select p_partkey % 100 as coupon_id, p_partkey as item_id, p_size from part
    union select (p_partkey * 7 + 3) % 100, p_partkey, p_size from part)
  where p_size <= 5 + (coupon_id % 10) * 5),
ci as (select coupon_id, i.* from coupon_item left join item i using (item_id)),
impression as (
  select o_orderkey as id, c.campaign_id, o_orderkey % 100 as coupon_id, o_custkey as customer_id,
         case when c.camp_ord <= 18 then 1 else 0 end as train_set,
         case when c.camp_ord > 18 then -9
              when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then 1 else 0 end as redemption_status
  from orders join campaign_o c on c.camp_ord = 1 + (o_orderkey * 7 + o_custkey) % 28),
raw_line as (select t.*, i.brand, i.brand_type as brand_label, i.category as category_label
  from txn t left join item i using (item_id)),
line0 as (
  select *, case brand_label when 'Established' then 0 when 'Local' then 1 end as brand_type,
         case category_label when 'ECONOMY' then 0 when 'LARGE' then 1 when 'MEDIUM' then 2
              when 'PROMO' then 3 when 'SMALL' then 4 when 'STANDARD' then 5 end as category,
         year(date) as t_yr, month(date) as t_mon, weekofyear(date) as t_wk, dayofyear(date) as t_d,
         isodow(date) - 1 as t_dwk, year(date) * 100 + month(date) as YMon,
         year(date) * 100 + dayofyear(date) as Yday,
         case when other_discount < 0 then 1 else 0 end as other_yes,
         case when coupon_discount < 0 then 1 else 0 end as coup_yes,
         selling_price / nullif(quantity, 0) as sp_qty,
         other_discount / nullif(quantity, 0) as other_dis_qty,
         coupon_discount / nullif(quantity, 0) as coup_dis_qty,
         coupon_discount / nullif(other_discount, 0) as cdis_p,
         date_diff('day', date '1970-01-01', date) + 719163 as date_ord
  from raw_line),
line1 as (select *, other_dis_qty + coup_dis_qty as tot_dis_qty from line0),
line2 as (select *, sp_qty + tot_dis_qty as pp_qty from line1),
line as (select *, sp_qty / nullif(pp_qty, 0) - 1 as dis_p from line2),
w as (
  select l.*, c.campaign_id, c.camp_ord, c.start_date, c.end_date,
         case c.campaign_type when 'X' then 0 when 'Y' then 1 end as campaign_type
  from line l join campaign_o c on l.date between c.start_date and c.end_date),
wr as (
  select *, row_number() over (partition by customer_id order by date desc, camp_ord, item_id, order_id,
         line_no, store_id, quantity, selling_price) as rn_all from w)"""

STATS = ("min", "max", "mean", "std")


def ints(*names: str) -> list[str]:
    return [f'cast("{n}" as bigint) as "{n}"' for n in names]


# Prices in cents divided by 8, 16, 32 ... often end in an exact half of the sixth digit, which the
# engines round to different sides. Both sides add this before rounding, so no value sits on a half.
OFF_HALF = 1.2e-8


def dbls(*names: str) -> list[str]:
    return [f'round(cast("{n}" as double) + {OFF_HALF}, 6) + 0.0 as "{n}"' for n in names]


def strs(*names: str) -> list[str]:
    return [f'"{n}"' for n in names]


def query(ctes: Iterable[str], columns: Iterable[str], source: str) -> str:
    """One statement: shared tables, own tables, rounded and typed output columns."""
    return f"with {','.join([BASE, *ctes])}\nselect {', '.join(columns)}\nfrom {source}"


def four(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in STATS]


def row_stats(name: str, source: str, value: str, prefix: str, form: str = "cumulative", key: str = "customer_id") -> str:
    """CTE ``name``: statistics of the non-null ``value`` per key, over explicit lists."""
    if form == "clean":
        return f"""{name} as (
  select {key}, min({value}) as "{prefix}_min", max({value}) as "{prefix}_max", avg({value}) as "{prefix}_mean",
         stddev_samp({value}) as "{prefix}_std" from {source} group by {key})"""
    return f"""{name}_l as (
  select {key}, list(cast({value} as double)) filter (where {value} is not null) as xs from {source} group by {key}),
{name}_m as (
  select {key}, xs, list_min(xs) as mn, list_max(xs) as mx,
         (list_sum(xs) + list_min(xs) + list_max(xs)) / (len(xs) + 2) as me from {name}_l),
{name} as (
  select {key}, mn as "{prefix}_min", mx as "{prefix}_max", me as "{prefix}_mean",
         case when mn is not null then list_aggregate(list_concat(xs, [mn, mx, me]), 'stddev_samp') end as "{prefix}_std"
  from {name}_m)"""


def dense(name: str, cells: str, fill: str = "null") -> list[str]:
    """CTE ``name``: customer x all observed keys with v, its rank and the difference to the left.

    ``cells`` names a table (customer_id, k, v). With fill = "share" all keys of the table count as
    observed, otherwise those with a value; "zero" fills empty cells with 0.
    """
    seen = "" if fill == "share" else "where v is not null"
    value = "coalesce(c.v, 0)" if fill == "zero" else "c.v"
    return [
        f"{name}_k as (select distinct k from {cells} {seen})",
        f"{name}_u as (select distinct customer_id from {cells} where v is not null)",
        f"""{name}_g as (
  select u.customer_id, s.k, {value} as v from {name}_u u cross join {name}_k s
  left join {cells} c on c.customer_id = u.customer_id and c.k = s.k)""",
        f"""{name} as (
  select customer_id, k, v, v - lag(v) over (partition by customer_id order by k) as d,
         row_number() over (partition by customer_id order by k) as pos,
         count(*) over (partition by customer_id) as last_pos from {name}_g)""",
    ]


GRID_KEYS = {"": "camp_ord", "_wk": "struct_pack(a := camp_ord, b := t_wk)", "_dwk": "struct_pack(a := camp_ord, b := t_dwk)"}


def count_cells(suffix: str) -> str:
    key = GRID_KEYS[suffix]
    return f"""cnt{suffix} as (
  select customer_id, {key} as k, count(*) as v, sum(coup_yes) as n_coup from w group by customer_id, {key})"""


def share_cells(suffix: str) -> str:
    """Needs count_cells; null for customers and for keys without any coupon row."""
    return f"""share{suffix} as (
  select customer_id, k, case when sum(n_coup) over (partition by customer_id) > 0
              and sum(n_coup) over (partition by k) > 0 then n_coup * 1.0 / nullif(v, 0) end as v from cnt{suffix})"""


PRICES = {
    "sp_qty_mean": "avg(sp_qty)",
    "sp_qty_std": "stddev_samp(sp_qty)",
    "coup_dis_qty_mean": "avg(coup_dis_qty)",
    "coup_dis_qty_std": "stddev_samp(coup_dis_qty)",
    "cdis_p_std": "stddev_samp(cdis_p)",
}


def price_cells(name: str, measure: str, where: str = "true") -> str:
    return f"""{name} as (
  select customer_id, camp_ord as k, {PRICES[measure]} as v from w where {where} group by customer_id, camp_ord)"""


class Part:
    """CTEs and the customer-grain table and columns they end in."""

    def __init__(self, ctes: list[str], table: str, columns: list[str]):
        self.ctes, self.table, self.columns = ctes, table, columns


def grid_part(cells_ctes: list[str], cells: str, prefix: str, fill: str, form: str = "cumulative") -> tuple[Part, Part]:
    """Level and difference statistics of one grid."""
    g = f"g_{cells}"
    base = [*cells_ctes, *dense(g, cells, fill)]
    level = Part([*base, row_stats(f"{g}_lv", g, "v", prefix, form)], f"{g}_lv", four(prefix))
    diff = Part([*base, row_stats(f"{g}_df", g, "d", f"{prefix}diff", form)], f"{g}_df", four(f"{prefix}diff"))
    return level, diff


def trajectory_parts(categories: int = 6, quirks: str = "original", form: str = "cumulative") -> dict[str, list[Part]]:
    """Parts per family name."""
    out: dict[str, list[Part]] = {}
    for suffix, trips, share in (("", "TT", "CT"), ("_wk", "wkT", "wkCT"), ("_dwk", "wkdT", "wkdCT")):
        count = count_cells(suffix)
        out[f"trip_change{suffix}"] = [grid_part([count], f"cnt{suffix}", trips, "zero", form)[1]]
        level, diff = grid_part([count, share_cells(suffix)], f"share{suffix}", share, "share", form)
        out[f"coupon_share{suffix}"], out[f"coupon_share_change{suffix}"] = [level], [diff]
    for col, stem in (("item_id", "item"), ("brand", "brand")):
        cells = f"""uniq_{stem} as (
  select customer_id, camp_ord as k, count(distinct {col}) * 1.0 / count(*) as v from w group by customer_id, camp_ord)"""
        out[f"{stem}_variety"] = [grid_part([cells], f"uniq_{stem}", f"TT_uniq_{stem}_p", "null", form)[0]]
    for m in PRICES:
        out[f"{m}_all"] = list(grid_part([price_cells(f"tt_{m}", m)], f"tt_{m}", f"TT_{m}", "null", form))
        where = "coup_yes = 1" if quirks == "clean" else "true"
        out[f"{m}_coupon"] = list(grid_part([price_cells(f"ct_{m}", m, where)], f"ct_{m}", f"CT_{m}", "null", form))
    if quirks == "original":
        level, _ = out["sp_qty_std_coupon"]
        level = Part(level.ctes, level.table, [f"CT_sp_qty_std_{s}" for s in ("min", "max", "std")])
        g = "g_ct_sp_qty_std"
        rest = f"{g}_rest as (select customer_id, case when pos < last_pos then d end as d from {g})"
        tail = row_stats(f"{g}_t", f"{g}_rest", "d", "CT_sp_qty_stddiff", form)
        stray = f"""{g}_s as (
  select customer_id, max(case when pos = last_pos then v end) as "CT_sp_qty_std_last_camp",
         max(case when pos = last_pos - 1 then d end) as "CT_sp_qty_stddiff_last_camp" from {g} group by customer_id)"""
        out["sp_qty_std_coupon"] = [
            level,
            Part([*level.ctes, rest, tail], f"{g}_t", [f"CT_sp_qty_stddiff_{s}" for s in ("min", "max", "std")]),
            Part([*level.ctes, stray], f"{g}_s", ["CT_sp_qty_std_last_camp", "CT_sp_qty_stddiff_last_camp"]),
        ]

    def segment(column: str, code: int, prefix: str, tag: str) -> Part:
        cells = f"""seg_{tag}{code} as (
  select customer_id, camp_ord as k, avg(coup_yes) as v from w where {column} = {code} group by customer_id, camp_ord)"""
        return Part(
            [cells, row_stats(f"seg_{tag}{code}_s", f"seg_{tag}{code}", "v", f"{prefix}{code}_mean", form)],
            f"seg_{tag}{code}_s",
            four(f"{prefix}{code}_mean"),
        )

    out["coupon_rate_by_campaign_type"] = [segment("campaign_type", k, "TT_coup_yes_camp", "ct") for k in (0, 1)]
    out["coupon_rate_by_brand_type"] = [segment("brand_type", k, "TT_coup_yes_brand", "bt") for k in (0, 1)]
    per_category = []
    for k in range(categories):
        cells = f"""cat{k} as (
  select customer_id, avg(v) as "TT_coup_yes_cat{k}_mean_mean" from (
    select customer_id, camp_ord, avg(coup_yes) as v from w where category = {k} group by customer_id, camp_ord)
  group by customer_id)"""
        per_category.append(Part([cells], f"cat{k}", [f"TT_coup_yes_cat{k}_mean_mean"]))
    out["coupon_rate_by_category"] = per_category
    return out


def join_parts(parts: list[Part], base: str | None = None) -> tuple[list[str], list[str], str]:
    """CTEs without repeats, columns, and the customer-grain join of all parts."""
    ctes: list[str] = []
    for p in parts:
        ctes += [c for c in p.ctes if c not in ctes]
    if base is None:
        union = " union ".join(f"select customer_id from {p.table}" for p in parts)
        base = f"({union})"
    source = f"{base} b " + " ".join(f"left join {p.table} using (customer_id)" for p in parts)
    return ctes, [c for p in parts for c in p.columns], source


def family_sql(name: str, quirks: str = "original", form: str = "cumulative") -> str:
    ctes, columns, source = join_parts(trajectory_parts(quirks=quirks, form=form)[name])
    return query(ctes, ints("customer_id") + dbls(*columns), source)


SUMMARY_INTS = (
    "total_coup_used", "total_trans", "total_other_coup_used", "unique_item", "unique_brand", "unique_category",
    "t_d_min", "t_d_max",
)
SUMMARY_DBLS = (
    "YMon_mean", "YMon_std", "t_dwk_mean", "t_dwk_std", "t_d_mean", "t_d_std",
    "qty_min", "qty_max", "qty_mean", "qty_std",
    *[f"{p}_{s}" for p in ("sp_qty", "other_dis_qty", "coup_dis_qty", "tot_dis_qty", "pp_qty", "dis_p", "cdis_p") for s in ("mean", "std")],
)
RATIOS = {
    "cust_item_uniq_p": ("unique_item", "total_trans"),
    "cust_brand_uniq_p": ("unique_brand", "total_trans"),
    "cust_categ_uniq_p": ("unique_category", "total_trans"),
    "cust_coup_used_p": ("total_coup_used", "total_trans"),
    "cust_other_coup_used_p": ("total_other_coup_used", "total_trans"),
    "cust_coupvsother_used_p": ("total_coup_used", "total_other_coup_used"),
}


def _ms(out: str, col: str) -> str:
    return f'avg({col}) as "{out}_mean", stddev_samp({col}) as "{out}_std"'


SUMMARY = f"""summary as (
  select customer_id, sum(coup_yes) as total_coup_used, count(coup_yes) as total_trans,
         sum(other_yes) as total_other_coup_used, count(distinct item_id) as unique_item,
         count(distinct brand) as unique_brand, count(distinct category) as unique_category,
         {_ms("YMon", "YMon")}, {_ms("t_dwk", "t_dwk")}, min(t_d) as t_d_min, max(t_d) as t_d_max, {_ms("t_d", "t_d")},
         min(quantity) as qty_min, max(quantity) as qty_max, {_ms("qty", "quantity")},
         {", ".join(_ms(p, p) for p in ("sp_qty", "other_dis_qty", "coup_dis_qty", "tot_dis_qty", "pp_qty", "dis_p", "cdis_p"))}
  from w group by customer_id)"""
RATIO_CTE = f"""ratios as (select customer_id, {", ".join(f'{a} * 1.0 / nullif({b}, 0) as "{o}"' for o, (a, b) in RATIOS.items())} from summary)"""
USED_INTS = ("unq_item_coup_used", "unq_brand_coup_used", "unq_categ_coup_used")
USED = """used as (
  select customer_id, count(distinct item_id) filter (where coup_yes = 1) as unq_item_coup_used,
         count(distinct brand) filter (where coup_yes = 1) as unq_brand_coup_used,
         count(distinct category) filter (where coup_yes = 1) as unq_categ_coup_used
  from w group by customer_id)"""
RECENCY_INTS = ("last_coup_days", "last_trans_day")


def recency_cte(year: int = 2001, ref_day: int = 184) -> str:
    return f"""recent as (
  select customer_id, {ref_day} - max(case when coup_yes = 1 and t_yr = {year} then t_d end) as last_coup_days,
         {ref_day} - max(case when t_yr = {year} then t_d end) as last_trans_day from w group by customer_id)"""


LAST = """last_rows as (
  select *, row_number() over (partition by customer_id order by date desc, camp_ord, item_id, order_id,
         line_no, store_id, quantity, selling_price) as rn from w where coup_yes = 1),
last10 as (
  select *, quantity - lag(quantity) over s as d_q, sp_qty - lag(sp_qty) over s as d_sp,
         other_dis_qty - lag(other_dis_qty) over s as d_odis, coup_dis_qty - lag(coup_dis_qty) over s as d_cdis,
         dis_p - lag(dis_p) over s as d_disp
  from last_rows where rn <= 10 window s as (partition by customer_id order by rn))"""
LAST_DAYS = """coupon_days as (
  select customer_id, date_ord, row_number() over (partition by customer_id order by date_ord desc) as rn
  from (select distinct customer_id, date_ord from w where coup_yes = 1)),
day_gaps as (
  select customer_id, date_ord - lag(date_ord) over (partition by customer_id order by rn) as d
  from coupon_days where rn <= 10)"""
LAST_COLUMNS = {"Q": "quantity", "SP": "sp_qty", "ODIS": "other_dis_qty", "CDIS": "coup_dis_qty", "DISP": "dis_p"}
LAST_UNIQUE = {"I_uniq": "item_id", "B_uniq": "brand", "C_uniq": "category"}


def last_part(prefix: str) -> list[Part]:
    if prefix == "T":
        return [Part([LAST_DAYS, row_stats("tdiff", "day_gaps", "d", "TDiff", "clean")], "tdiff", four("TDiff"))]
    step = f"l_{prefix}d"
    parts = [Part([LAST, row_stats(step, "last10", f"d_{prefix.lower()}", f"{prefix}Diff", "clean")], step, four(f"{prefix}Diff"))]
    if prefix != "Q":
        level = f"l_{prefix}"
        parts.append(Part([LAST, row_stats(level, "last10", LAST_COLUMNS[prefix], prefix, "clean")], level, four(prefix)))
    return parts


def unique_cte(name: str) -> str:
    return f"u_{name} as (select customer_id, count(distinct {LAST_UNIQUE[name]}) as {name} from last10 group by customer_id)"


MODES = ("brand", "category", "item_id", "YMon", "t_mon", "t_wk", "t_dwk")


def mode_cte(column: str, coupon: bool) -> tuple[str, str]:
    out = f"MC{column}{'dis' if coupon else ''}"
    where = f"{column} is not null" + (" and coup_yes = 1" if coupon else "")
    text = f"""m_{out} as (
  select customer_id, {column} as "{out}" from (
    select customer_id, {column}, row_number() over (partition by customer_id order by count(*) desc, min(rn_all)) as place
    from wr where {where} group by customer_id, {column}) where place = 1)"""
    return text, out


def customer_parts(categories: int = 6) -> tuple[list[str], list[str], list[str], list[str], str]:
    """The whole customer table: CTEs, integer, double and text columns, source."""
    parts = [p for ps in trajectory_parts(categories).values() for p in ps]
    for prefix in ("T", *LAST_COLUMNS):
        parts += last_part(prefix)
    ctes, doubles, joins = join_parts(parts, "summary")
    extra = [SUMMARY, RATIO_CTE, USED, recency_cte(), *[unique_cte(u) for u in LAST_UNIQUE]]
    joins += " left join ratios using (customer_id) left join used using (customer_id) left join recent using (customer_id)"
    integers = ["customer_id", *SUMMARY_INTS, *USED_INTS, *RECENCY_INTS, *LAST_UNIQUE]
    joins += "".join(f" left join u_{u} using (customer_id)" for u in LAST_UNIQUE)
    text = []
    for column in MODES:
        for coupon in (False, True):
            cte, out = mode_cte(column, coupon)
            extra.append(cte)
            joins += f" left join m_{out} using (customer_id)"
            (text if column == "brand" else integers).append(out)
    return [*ctes, *extra], integers, [*SUMMARY_DBLS, *RATIOS, *doubles], text, joins


def customer_table_sql() -> str:
    ctes, integers, doubles, text, source = customer_parts()
    return query(ctes, ints(*integers) + dbls(*doubles) + strs(*text), source)


# Offers -------------------------------------------------------------------------------------

OFFER = """offer0 as (
  select i.*, c.start_date, c.end_date, case c.campaign_type when 'X' then 0 when 'Y' then 1 end as campaign_type,
         year(c.start_date) as s_yr, month(c.start_date) as s_mon, weekofyear(c.start_date) as s_wk,
         day(c.start_date) as s_d, isodow(c.start_date) - 1 as s_dwk,
         year(c.end_date) as e_yr, month(c.end_date) as e_mon, weekofyear(c.end_date) as e_wk,
         day(c.end_date) as e_d, isodow(c.end_date) - 1 as e_dwk,
         date_diff('day', c.start_date, c.end_date) as diff_camp_days,
         date_diff('day', date '1970-01-01', c.start_date) + 719163 as start_date_ord,
         date_diff('day', date '1970-01-01', c.end_date) + 719163 as end_date_ord
  from impression i left join campaign c using (campaign_id))"""
CAMPAIGN_INTS = (
    "campaign_type", "s_yr", "s_mon", "s_wk", "s_d", "s_dwk", "e_yr", "e_mon", "e_wk", "e_d", "e_dwk",
    "diff_camp_days", "start_date_ord", "end_date_ord",
)
BREADTH = """breadth as (
  select o.*, a.camp_coupon_idnunique, a.camp_customer_idnunique, a.camp_id_count, b.camp_coup_unique_cust,
         c.camp_cus_unique_coup,
         camp_coupon_idnunique * 1.0 / nullif(camp_id_count, 0) as camp_coup_uniq_p,
         camp_customer_idnunique * 1.0 / nullif(camp_id_count, 0) as camp_cus_uniq_p,
         camp_coup_unique_cust * 1.0 / nullif(camp_id_count, 0) as camp_coup_cus_uniq_p,
         camp_cus_unique_coup * 1.0 / nullif(camp_id_count, 0) as camp_cus_coup_uniq_p
  from offer0 o
  left join (select campaign_id, count(distinct coupon_id) as camp_coupon_idnunique,
                    count(distinct customer_id) as camp_customer_idnunique, count(id) as camp_id_count
             from impression group by campaign_id) a using (campaign_id)
  left join (select campaign_id, coupon_id, count(distinct customer_id) as camp_coup_unique_cust
             from impression group by all) b using (campaign_id, coupon_id)
  left join (select campaign_id, customer_id, count(distinct coupon_id) as camp_cus_unique_coup
             from impression group by all) c using (campaign_id, customer_id))"""
BREADTH_INTS = (
    "camp_coupon_idnunique", "camp_customer_idnunique", "camp_id_count", "camp_coup_unique_cust", "camp_cus_unique_coup",
)
BREADTH_DBLS = ("camp_coup_uniq_p", "camp_cus_uniq_p", "camp_coup_cus_uniq_p", "camp_cus_coup_uniq_p")
REACH = (1, 2, 3, -1, -2, -3)
SEQUENCES = {
    "cus_str": ("start_date_ord", "start_date_ord, train_set desc, id"),
    "cus_camp": ("campaign_id", "campaign_id, start_date_ord, train_set desc, id"),
    "cus_coup": ("coupon_id", "coupon_id, start_date_ord, campaign_id, train_set desc, id"),
    "cus_end": ("end_date_ord", "start_date_ord, coupon_id, campaign_id, train_set desc, id"),
}


def shift_names(prefix: str) -> list[str]:
    return [f"{prefix}_shift{'' if k > 0 else 'n'}{abs(k)}" for k in REACH]


def shift_exprs(prefix: str) -> str:
    value, order = SEQUENCES[prefix]
    window = f"over (partition by customer_id order by {order})"
    return ", ".join(
        f"{'lag' if k > 0 else 'lead'}({value}, {abs(k)}) {window} as {n}" for k, n in zip(REACH, shift_names(prefix))
    )


NEIGHBOURS = f"neighbours as (select *, {', '.join(shift_exprs(p) for p in SEQUENCES)} from breadth)"
START_GAPS = [f"diff{'' if k > 0 else 'n'}{abs(k)}_cus_str" for k in REACH]
END_GAPS = [f"diff{'' if k > 0 else 'n'}{abs(k)}_cus_end" for k in REACH]
GAPS = f"""gaps as (select *,
  {", ".join(f"start_date_ord - {n} as {g}" for n, g in zip(shift_names("cus_str"), START_GAPS))},
  cus_end_shift1 - start_date_ord as diff1_cus_end, cus_end_shift2 - cus_str_shift1 as diff2_cus_end,
  cus_end_shift3 - cus_str_shift2 as diff3_cus_end, cus_end_shiftn1 - start_date_ord as diffn1_cus_end,
  cus_end_shiftn2 - cus_str_shiftn1 as diffn2_cus_end, cus_end_shiftn3 - cus_str_shiftn2 as diffn3_cus_end
  from neighbours)"""
OFFER_CTES = [OFFER, BREADTH, NEIGHBOURS, GAPS]
OFFER_KEYS = ("id", "campaign_id", "coupon_id", "customer_id", "train_set", "redemption_status")
OFFER_INTS = (
    *OFFER_KEYS, *CAMPAIGN_INTS, *BREADTH_INTS, *[n for p in SEQUENCES for n in shift_names(p)], *START_GAPS, *END_GAPS,
)

# Coupons ------------------------------------------------------------------------------------

CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
BRAND_TYPES = ("Established", "Local")
COUPON_SUMMARY = """coupon_sum as (
  select coupon_id, count(distinct brand) as coup_brand_uniq, count(brand) as coup_brand_cnt,
         count(distinct brand) * 1.0 / nullif(count(brand), 0) as coup_brand_uniq_p,
         count(distinct category) as coup_categ_uniq, count(category) as coup_categ_cnt,
         count(distinct category) * 1.0 / nullif(count(category), 0) as coup_categ_uniq_p
  from ci group by coupon_id)"""
COUPON_SUM_INTS = ("coup_brand_uniq", "coup_brand_cnt", "coup_categ_uniq", "coup_categ_cnt")
COUPON_SUM_DBLS = ("coup_brand_uniq_p", "coup_categ_uniq_p")


def coupon_mode_cte(column: str, out: str) -> str:
    return f"""cm_{column} as (
  select coupon_id, {column} as {out} from (
    select coupon_id, {column}, row_number() over (partition by coupon_id order by count(*) desc, min(item_id)) as place
    from ci where {column} is not null group by coupon_id, {column}) where place = 1)"""


COUPON_MODES = [
    coupon_mode_cte("brand", "MCCoupbrand"),
    coupon_mode_cte("category", "MCCoupcategory_c"),
    f"""coupon_modes as (select coupon_id, MCCoupbrand, MCCoupcategory_c,
  {", ".join(f"case when MCCoupcategory_c = '{x}' then 1 else 0 end as MCCoupcategory_{x}" for x in CATEGORIES)}
  from (select distinct coupon_id from ci) left join cm_brand using (coupon_id) left join cm_category using (coupon_id))""",
]
COUPON_MODE_INTS = tuple(f"MCCoupcategory_{x}" for x in CATEGORIES)
COUPON_COUNTS = f"""coupon_counts as (
  select coupon_id, {", ".join(f"count(*) filter (where category = '{x}') as {x}_cnt" for x in CATEGORIES)}
  from ci group by coupon_id)"""
COUPON_COUNT_INTS = tuple(f"{x}_cnt" for x in CATEGORIES)
COUPON_BREADTH = f"""kinds as (select distinct coupon_id, brand_type, category from ci),
types as (select distinct coupon_id, brand_type from ci),
coupon_breadth as (
  select * from (select coupon_id,
    {", ".join(f"sum(case when category = '{x}' then 1 else 0 end) as Coup_category_{x}_ohesum" for x in CATEGORIES)}
    from kinds group by coupon_id)
  join (select coupon_id,
    {", ".join(f"sum(case when brand_type = '{x}' then 1 else 0 end) as Coup_brand_type_{x}_ohesum" for x in BRAND_TYPES)}
    from types group by coupon_id) using (coupon_id))"""
COUPON_BREADTH_INTS = (
    *[f"Coup_category_{x}_ohesum" for x in CATEGORIES],
    *[f"Coup_brand_type_{x}_ohesum" for x in BRAND_TYPES],
)
COUPON_CTES = [COUPON_SUMMARY, *COUPON_MODES, COUPON_COUNTS, COUPON_BREADTH]
COUPON_TABLE = "coupon_sum left join coupon_modes using (coupon_id) left join coupon_counts using (coupon_id) left join coupon_breadth using (coupon_id)"
COUPON_INTS = (*COUPON_SUM_INTS, *COUPON_MODE_INTS, *COUPON_COUNT_INTS, *COUPON_BREADTH_INTS)
