"""CTE building blocks and the per-query statements."""

from __future__ import annotations

from scrubline import vocab as V
from scrubline.sources import fixtures

SPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TOKENS = r"('', ' ', 'nan', 'NaN', 'NAN', 'null', 'NULL', 'None', '\N', '-', '?')"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
QUOTE_FROM, QUOTE_TO = V.NAME_QUOTES_FROM, V.NAME_QUOTES_TO


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duck(sql: str, source: str) -> str:
    return sql.format(**{source: source}).replace("as string", "as varchar").strip()


def folded(x: str) -> str:
    return f"replace({x}, chr(160), ' ')"


def stripped(x: str) -> str:
    return f"regexp_replace({folded(x)}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def text_cte(name: str, source: str, column: str) -> str:
    """``raw -> folded, stripped, single, text`` and the two text operations."""
    return f"""{name}_a as (select *, {folded(column)} as folded, {stripped(column)} as stripped from {source}),
{name}_b as (select *, regexp_replace(stripped, '{SPACE}+', ' ', 'g') as single from {name}_a),
{name} as (select *, case when single not in {TOKENS} then single end as txt,
    case when stripped <> folded then 'trimmed' end as op_trim,
    case when single <> stripped then 'spaces_collapsed' end as op_space from {name}_b)"""


def price(x: str) -> str:
    plain = f"replace(replace({x}, ',', ''), '$', '')"
    return f"case when regexp_matches({plain}, '{NUMBER}') then printf('%.2f', try_cast({plain} as double)) end"


def name_ctes(name: str, source: str, column: str) -> str:
    seps = "-/():;[]{}<>|\\_~"
    return f"""{text_cte(name + '_t', source, column)},
{name}_1 as (select *, translate(txt, {lit(QUOTE_FROM)}, {lit(QUOTE_TO)}) as quoted from {name}_t),
{name}_2 as (select *, strip_accents(quoted) as plain from {name}_1),
{name}_3 as (select *, upper(replace(plain, 'ß', 'SS')) as up from {name}_2),
{name}_4 as (select *, replace(up, '&', ' AND ') as expanded,
    coalesce(regexp_matches(txt, '[\\p{{L}}\\p{{N}}]'), false) as named from {name}_3),
{name}_5 as (select *, translate(expanded, {lit(seps)}, {lit(' ' * len(seps))}) as spaced,
    named and not regexp_matches(up, '[^\\x00-\\x7f]') as latin from {name}_4),
{name}_6 as (select *, regexp_replace(spaced, '[^A-Z0-9 '',]', '', 'g') as kept from {name}_5),
{name}_7 as (select *, trim(regexp_replace(kept, ' +', ' ', 'g')) as tidy from {name}_6),
{name}_8 as (select *, latin and regexp_matches(tidy, '[A-Z0-9]') as good from {name}_7),
{name} as (select *, case when good then tidy else 'UNKNOWN' end as cname,
    concat_ws(';', op_trim, op_space,
      case when named and quoted <> txt then 'quotes_normalized' end,
      case when named and plain <> quoted then 'accents_folded' end,
      case when named and up <> plain then 'uppercased' end,
      case when latin and expanded <> up then 'ampersand_expanded' end,
      case when latin and spaced <> expanded then 'punct_to_space' end,
      case when latin and kept <> spaced then 'punct_removed' end,
      case when latin and tidy <> kept and op_space is null then 'spaces_collapsed' end,
      case when good then null else 'marked_unknown' end) as name_ops from {name}_8)"""


IN_SCOPE = """currency = 'Dollars' and status = 'complete' and trim(date) <> ''
    and coalesce(try_cast(substr(date, 1, 4) as int) between 1840 and 2026, false)"""

RAW = {
    "menu_raw": duck(fixtures.MENU, "orders"),
    "page_raw": duck(fixtures.PAGE, "lineitem"),
    "item_raw": duck(fixtures.ITEM, "lineitem"),
    "dish_raw": duck(fixtures.DISH, "part"),
}


def menu_clean(name: str, source: str, constant: bool) -> str:
    """Cleaned menus; ids of the derived table never need work."""
    tail = ", 'status:column_dropped'" if constant else ""
    return f"""{name}_p as (select *, regexp_matches(trim(date), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') as iso from {source}),
{name}_q as (select *, case when iso then substr(trim(date), 1, 4)::int end as y,
    case when iso then substr(trim(date), 6, 2)::int end as mo, case when iso then substr(trim(date), 9, 2)::int end as d from {name}_p),
{name}_r as (select *, coalesce(y between 1840 and 2026 and mo between 1 and 12 and d between 1 and 31, false) as ok from {name}_q),
{name} as (select cast(id as bigint) as id, date as raw_date, currency as raw_currency, status,
    case when currency = '' then null when currency = 'Dollars' then 'USD' else currency end as currency,
    case when ok then y end as year, case when ok then mo end as month, case when ok then d end as day,
    concat_ws(';', case when ok then 'date:date_split' end, 'date:column_dropped',
      case when currency = 'Dollars' then 'currency:currency_mapped' end{tail}) as log from {name}_r)"""


def capped(name: str, source: str, low: str, high: str) -> str:
    """Winsorize two cleaned price columns at the 0.995 quantile of their positive values."""
    def cap(c: str) -> str:
        return f"(select quantile_cont(try_cast({c}_2dp as double), 0.995) from {source} where try_cast({c}_2dp as double) > 0)"

    return f"""{name}_caps as (select {cap(low)} as cap_low, {cap(high)} as cap_high),
{name} as (select s.*, coalesce(try_cast({low}_2dp as double) > cap_low, false) as over_low,
    coalesce(try_cast({high}_2dp as double) > cap_high, false) as over_high,
    case when coalesce(try_cast({low}_2dp as double) > cap_low, false) then printf('%.2f', cap_low) else {low}_2dp end as {low}_c,
    case when coalesce(try_cast({high}_2dp as double) > cap_high, false) then printf('%.2f', cap_high) else {high}_2dp end as {high}_c
  from {source} s, {name}_caps)"""


def price_log(c: str, over: str) -> str:
    return f"case when {c}_2dp <> trim({c}) then '{c}:to_decimal_2dp' end"


ITEM_CLEAN = f"""item_p as (select cast(id as bigint) as id, cast(menu_page_id as bigint) as menu_page_id,
    try_cast(nullif(dish_id, '') as bigint) as dish_id, price, high_price, {price('price')} as price_2dp, {price('high_price')} as high_price_2dp from item_raw),
{capped('item_w', 'item_p', 'price', 'high_price')},
item_all as (select id, menu_page_id, price as raw_price, high_price as raw_high, price_2dp, high_price_2dp, over_low, over_high,
    price_c as price, high_price_c as high_price, dish_id,
    dish_id is null and not coalesce(price_c::double > 0, false) and not coalesce(high_price_c::double > 0, false) as omit,
    concat_ws(';', {price_log('price', '')}, {price_log('high_price', '')}, case when over_low then 'price:winsorized' end,
      case when over_high then 'high_price:winsorized' end) as plog from item_w),
item_clean as (select *, concat_ws(';', nullif(plog, ''), case when omit then 'omit:no_dish_id_and_no_price' end) as log from item_all)"""


def dish_clean(name: str, source: str) -> str:
    return f"""{name_ctes(name + '_n', source, 'name')},
{name}_p as (select cast(id as bigint) as id, name as raw_name, cname as name, name_ops, lowest_price, highest_price,
    {price('lowest_price')} as lowest_price_2dp, {price('highest_price')} as highest_price_2dp from {name}_n),
{capped(name + '_w', name + '_p', 'lowest_price', 'highest_price')},
{name} as (select id, raw_name, name, name_ops, lowest_price as raw_low, highest_price as raw_high, lowest_price_2dp, highest_price_2dp,
    over_low, over_high, lowest_price_c as lowest_price, highest_price_c as highest_price,
    concat_ws(';', case when name_ops <> '' then 'name:' || replace(name_ops, ';', ';name:') end,
      {price_log('lowest_price', '')}, {price_log('highest_price', '')},
      case when over_low then 'lowest_price:winsorized' end, case when over_high then 'highest_price:winsorized' end) as log from {name}_w)"""


PAIR = "menu_page_id, dish_id"


def repaired(name: str, source: str) -> str:
    def mean(c: str) -> str:
        return f"round(avg(distinct {c}) filter (where price is not null), 9)"

    return f"""{name}_z as (select id, menu_page_id, case when price = 0 then high_price else price end as price, high_price, dish_id
    from {source} where not coalesce(price = 0 and high_price = 0, false)),
{name}_g as (select {PAIR}, count(distinct price) as n, count(*) as lines, count(price) as priced, min(id) filter (where price is not null) as keep_id,
    {mean('price')} as mean_price, {mean('high_price')} as mean_high from {name}_z where dish_id is not null group by {PAIR}),
{name} as (select z.id, z.menu_page_id, case when g.n > 1 then mean_price else z.price end as price,
    case when g.n > 1 then mean_high else z.high_price end as high_price, z.dish_id
  from {name}_z z left join {name}_g g on z.menu_page_id = g.menu_page_id and z.dish_id = g.dish_id
  where g.n is null or (g.n > 1 and z.id = g.keep_id) or g.n = 0 or (g.n = 1 and (z.price is not null or g.lines = g.priced)))"""


# name -> definition, in dependency order; a query lists only what it needs (closed over).
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    **{n: ((), f"{n} as ({sql})") for n, sql in RAW.items()},
    "menu_export": (("menu_raw",), f"menu_export as (select * from menu_raw where {IN_SCOPE})"),
    "dish_export": (("dish_raw",), "dish_export as (select * from dish_raw where trim(lowest_price) <> '' or trim(highest_price) <> '')"),
    "menu_clean": (("menu_raw",), menu_clean("menu_clean", "menu_raw", False)),
    "menu_scoped": (("menu_export",), menu_clean("menu_scoped", "menu_export", True)),
    "page_clean": (("page_raw",), "page_clean as (select cast(id as bigint) as id, cast(menu_id as bigint) as menu_id from page_raw)"),
    "item_clean": (("item_raw",), ITEM_CLEAN),
    "dish_clean": (("dish_raw",), dish_clean("dish_clean", "dish_raw")),
    "dish_scoped": (("dish_export",), dish_clean("dish_scoped", "dish_export")),
    "stg_menu_all": (("menu_clean",), "stg_menu_all as (select id, currency, year, month, day from menu_clean)"),
    "stg_menu": (("menu_scoped",), "stg_menu as (select id, currency, year, month, day from menu_scoped)"),
    "stg_item": (("item_clean",), "stg_item as (select id, menu_page_id, price::double as price, high_price::double as high_price, dish_id from item_clean where not omit)"),
    "stg_dish_all": (("dish_clean",), "stg_dish_all as (select id, name, lowest_price::double as lowest_price, highest_price::double as highest_price from dish_clean)"),
    "stg_dish": (("dish_scoped",), "stg_dish as (select id, name, lowest_price::double as lowest_price, highest_price::double as highest_price from dish_scoped)"),
    "ld_page": (("page_clean", "stg_menu"), "ld_page as (select * from page_clean where menu_id in (select id from stg_menu))"),
    "on_page": (("stg_item", "ld_page"), "on_page as (select * from stg_item where menu_page_id in (select id from ld_page))"),
    "ld_item": (("on_page", "stg_dish"), "ld_item as (select * from on_page where dish_id in (select id from stg_dish))"),
    "rep_item": (("ld_item",), repaired("rep_item", "ld_item")),
    "final_item": (
        ("rep_item", "ld_page", "stg_dish"),
        "final_item as (select i.id as menu_item_id, p.menu_id, d.name as dish_name, i.price as clean_item_price from rep_item i join ld_page p on p.id = i.menu_page_id join stg_dish d on d.id = i.dish_id)",
    ),
    "menu_avg": (
        ("final_item", "stg_menu"),
        """menu_avg as (select f.menu_id, m.year as period, count(*) as item_count,
      round(avg(clean_item_price), 9) as avg_price
    from final_item f join stg_menu m on m.id = f.menu_id where clean_item_price > 0 group by f.menu_id, m.year)""",
    ),
    "messy": (
        (),
        """messy as (select o_orderkey as id, case o_orderkey % 9
      when 0 then concat(' ', cast(o_orderkey as varchar), ' ')
      when 1 then concat('$', cast(cast(o_totalprice as decimal(18,2)) as varchar))
      when 2 then concat(cast(o_orderkey % 1000 as varchar), ',000')
      when 3 then concat(cast(o_orderkey % 500 as varchar), '.125')
      when 4 then 'nan' when 5 then concat(cast(o_orderkey as varchar), 'd')
      when 6 then concat('-', cast(o_orderkey % 90 as varchar), '.5')
      when 7 then concat(cast(o_orderkey % 90 as varchar), 'e2') else '' end as raw from orders)""",
    ),
    "texts": (
        ("dish_raw",),
        "texts as (select 'dish' as source, id, name as raw from dish_raw union all select 'document', cast(doc_id as varchar), text from documents)",
    ),
    "part_names": (
        (),
        """part_names as (select p_partkey as id, case p_partkey % 3 when 0 then concat(split_part(p_name, ' ', 2), ', ', split_part(p_name, ' ', 1))
      when 1 then concat(upper(p_name), '.') else p_name end as name from part)""",
    ),
    "name_variants": (
        (),
        """name_variants as (select case p_partkey % 3 when 0 then concat(split_part(p_name, ' ', 2), ', ', split_part(p_name, ' ', 1))
      when 1 then concat(upper(p_name), '.') else p_name end as name from part)""",
    ),
}


def sql(needs: str, select: str, *extra: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in CTES[name][0]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        add(name)
    parts = [CTES[n][1] for n in ordered] + list(extra)
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select


ORACLES: dict[str, str] = {}
O = ORACLES

# --- value cleaners ---------------------------------------------------------
O["normalize_text"] = sql("texts", "select source, id, txt as value, concat_ws(';', op_trim, op_space) as ops from t", text_cte("t", "texts", "raw"))
O["clean_int"] = sql(
    "messy",
    """select id, raw, value, concat_ws(';', op_trim, op_space, case when cast(value as varchar) <> txt then 'to_int' end) as ops
  from (select *, coalesce(case when regexp_matches(plain, '^[+-]?\\d+$') then try_cast(plain as bigint) end,
      case when regexp_matches(plain, '%s') then try_cast(trunc(try_cast(plain as double)) as bigint) end) as value
    from (select *, replace(txt, ',', '') as plain from t))""" % NUMBER,
    text_cte("t", "messy", "raw"),
)
O["clean_price"] = sql(
    "messy",
    f"""select id, raw, value, concat_ws(';', op_trim, op_space, case when value <> txt then 'to_decimal_2dp' end) as ops
  from (select *, {price('txt')} as value from t)""",
    text_cte("t", "messy", "raw"),
)
O["date_split"] = sql("menu_raw menu_clean", "select cast(id as varchar) as id, raw_date as raw, year, month, day, case when year is not null then 'date_split' else '' end as ops from menu_clean")
O["currency_map"] = sql("menu_clean", "select cast(id as varchar) as id, raw_currency as raw, currency as value, case when raw_currency = 'Dollars' then 'currency_mapped' else '' end as ops from menu_clean")
O["unmapped_currencies"] = sql("menu_clean", "select currency, count(*) as menus from menu_clean where currency <> 'USD' group by currency")
O["fold_accents"] = sql("texts", "select source, id, strip_accents(raw) as value from texts")
O["clean_name"] = sql("texts", "select source, id, cname as value, name_ops as ops from n", name_ctes("n", "texts", "raw"))

O["clean_custom"] = sql(
    "dish_raw",
    """select cast(id as varchar) as id, cname as name, 'dish.csv' as source_file, cast(id as bigint) as source_row_num,
    concat_ws(';', case when masked <> name then 'name:digits_masked' end, case when name_ops <> '' then 'name:' || replace(name_ops, ';', ';name:') end) as log from n""",
    "masked as (select *, regexp_replace(name, '[0-9]+', 'N', 'g') as masked from dish_raw)",
    name_ctes("n", "masked", "masked"),
)

# --- provenance -------------------------------------------------------------
O["row_stamp"] = "select l_orderkey, l_linenumber, l_partkey, 'lineitem.parquet' as source_file, row_number() over () as source_row_num, '' as log from lineitem"
O["row_log"] = sql(
    "menu_clean page_clean item_clean dish_clean",
    """select 'menu' as "table", id as source_row_num, id, log from menu_clean union all select 'menu_page', id, id, '' from page_clean
  union all select 'menu_item', id, id, log from item_clean union all select 'dish', id, id, log from dish_clean""",
)


def winsor_changes(table: str, source: str, c: str, over: str, before: str) -> str:
    return f"select '{table}', 'price-outlier', '{table}.csv', id, cast(id as varchar), '{c}', {before}, {c}, 'winsorized' from {source} where {over}"


O["change_log"] = sql(
    "menu_clean item_clean dish_clean",
    f"""select 'menu' as "table", 'currency-map' as step, 'menu.csv' as source_file, id as source_row_num, cast(id as varchar) as row_id, 'currency' as "column",
    raw_currency as before, currency as after, case when raw_currency = 'Dollars' then 'currency_mapped' else '' end as operations
  from menu_clean where raw_currency <> coalesce(currency, '')
  union all select 'dish', 'dish-name', 'dish.csv', id, cast(id as varchar), 'name', raw_name, name, name_ops from dish_clean
    where raw_name <> name and name_ops not in ('', 'uppercased')
  union all {winsor_changes('menu_item', 'item_clean', 'price', 'over_low', 'price_2dp')}
  union all {winsor_changes('menu_item', 'item_clean', 'high_price', 'over_high', 'high_price_2dp')}
  union all {winsor_changes('dish', 'dish_clean', 'lowest_price', 'over_low', 'lowest_price_2dp')}
  union all {winsor_changes('dish', 'dish_clean', 'highest_price', 'over_high', 'highest_price_2dp')}""",
)


def summary(menu: str, dish: str) -> str:
    rows: list[tuple[str, str, str, str, str, str, bool]] = []
    add = lambda *r, always=False: rows.append((*r, always))
    add("menu", "date-split", "year, month, day", "date_split", menu, "year is not null")
    add("menu", "date-split", "date", "column_dropped", menu, "true", always=True)
    add("menu", "date-split", "date", "invalid_date", menu, "year is null")
    add("menu", "currency-map", "currency", "currency_mapped", menu, "raw_currency = 'Dollars'")
    add("menu", "currency-map", "currency", "ambiguous_currency", menu, "currency <> 'USD'")
    if menu == "menu_scoped":
        add("menu", "drop-status", "status", "column_dropped", menu, "true", always=True)
    add("menu_item", "id-numeric", "dish_id", "missing_required_id", "item_clean", "dish_id is null", always=True)
    for op in ("trimmed", "spaces_collapsed", "quotes_normalized", "accents_folded", "uppercased", "ampersand_expanded", "punct_to_space", "punct_removed", "marked_unknown"):
        add("dish", "dish-name", "name", op, dish, f"list_contains(string_split(name_ops, ';'), '{op}')")
    for table, source, pair in (("menu_item", "item_clean", ("price", "high_price")), ("dish", dish, ("lowest_price", "highest_price"))):
        for c, raw, over in zip(pair, ("raw_price", "raw_high") if table == "menu_item" else ("raw_low", "raw_high"), ("over_low", "over_high")):
            add(table, "price-decimal", c, "to_decimal_2dp", source, f"{c}_2dp <> {raw}")
            add(table, "price-decimal", c, "missing_price", source, f"{c}_2dp is null", always=table == "menu_item")
            add(table, "price-decimal", c, "non_positive_price", source, f"{c}_2dp::double <= 0")
            add(table, "price-outlier", c, "winsorized", source, over)
            add(table, "price-outlier", c, "suspicious_extreme_price", source, over)
    add("menu_item", "omit-check", "omit", "no_dish_id_and_no_price", "item_clean", "omit", always=True)
    selects = [
        f"""select '{t}' as "table", '{s}' as step, '{c}' as "column", '{o}' as operation, count(*) filter (where {p}) as rows_affected, {str(a).lower()} as keep from {src}"""
        for t, s, c, o, src, p, a in rows
    ]
    return "s as (" + "\nunion all ".join(selects) + "),\nsummary as (select * exclude (keep) from s where keep or rows_affected > 0)"


O["stage_summary"] = sql("menu_clean item_clean dish_clean", "select * from summary", summary("menu_clean", "dish_clean"))
O["cleaning_log"] = sql("menu_scoped item_clean dish_scoped", "select * from summary", summary("menu_scoped", "dish_scoped"))
O["cleaning_log_totals"] = sql(
    "menu_scoped item_clean dish_scoped",
    """select "table", count(*) as rules, cast(sum(rows_affected) as bigint) as cell_changes from summary group by "table" """,
    summary("menu_scoped", "dish_scoped"),
)
O["drop_constant"] = sql("menu_scoped", "select id, currency, year, month, day, 'menu.csv' as source_file, id as source_row_num, log from menu_scoped")
O["clean_menu"] = sql("menu_clean", "select id, currency, status, year, month, day from menu_clean")
O["clean_menu_page"] = sql("page_clean", "select id, menu_id from page_clean")
O["clean_menu_item"] = sql("item_clean", "select id, menu_page_id, price, high_price, dish_id from item_clean where not omit")
O["clean_dish"] = sql("dish_clean", "select id, name, lowest_price, highest_price from dish_clean")
O["omit_rows"] = sql("item_clean", "select id, menu_page_id, price, high_price, dish_id, 'menu_item.csv' as source_file, id as source_row_num, 1 as omit, log from item_clean where omit")
O["winsorize"] = sql("item_clean", "select id, menu_page_id, price, high_price, dish_id, 'menu_item.csv' as source_file, id as source_row_num, plog as log from item_clean")
O["winsorize_dish"] = sql("dish_clean", "select id, name, lowest_price, highest_price, 'dish.csv' as source_file, id as source_row_num, log from dish_clean")


def verdict(table: str, source: str, warnings: str, excluded: str, changed: str) -> str:
    return f"""select '{table}' as "table", id as source_row_num, id,
    case when {excluded} is not null then 'excluded' when w <> '' then 'warning' when {changed} then 'cleaned' else 'ok' end as cleaning_status,
    nullif(w, '') as warning_reason, {excluded} as exclusion_reason
  from (select *, {warnings} as w from {source})"""


def price_warnings(raw: str, c: str, over: str) -> str:
    return f"case when {raw} = '' then '{c}:missing_price' end, case when {c}::double <= 0 then '{c}:non_positive_price' end, case when {over} then '{c}:suspicious_extreme_price' end"


NONE = "cast(null as varchar)"
O["row_status"] = sql(
    "menu_clean page_clean item_clean dish_clean",
    verdict(
        "menu",
        "menu_clean",
        "concat_ws(';', case when raw_date = '' then 'date:missing_date' end, case when raw_date <> '' and year is null then 'date:invalid_date' end, case when currency is null then 'currency:missing_currency' end, case when currency <> 'USD' then 'currency:ambiguous_currency' end)",
        NONE,
        "year is not null or raw_currency = 'Dollars'",
    )
    + "\nunion all "
    + verdict("menu_page", "page_clean", "''", NONE, "false")
    + "\nunion all "
    + verdict(
        "menu_item",
        "item_clean",
        f"concat_ws(';', {price_warnings('raw_price', 'price', 'over_low')}, {price_warnings('raw_high', 'high_price', 'over_high')}, case when dish_id is null then 'dish_id:missing_required_id' end)",
        "case when omit then 'no_dish_id_and_no_price' end",
        "log <> ''",
    )
    + "\nunion all "
    + verdict(
        "dish",
        "dish_clean",
        f"concat_ws(';', {price_warnings('raw_low', 'lowest_price', 'over_low')}, {price_warnings('raw_high', 'highest_price', 'over_high')})",
        NONE,
        "log <> ''",
    ),
)
def lost(table: str, rule: str, source: str, where: str, iteration: int = 0, kept: str = "null") -> str:
    """Rows of the derived tables, whose row number is their key."""
    file = f"'{table}.csv'" if kept != "null" else "null"
    return f"""select '{table}' as "table", '{table}.csv' as source_file, cast({source}.id as bigint) as source_row_num, cast({source}.id as varchar) as row_key, {rule} as rule,
    {iteration} as iteration, cast({file} as varchar) as kept_source_file, cast({kept} as bigint) as kept_source_row_num from {where}"""


IN_GROUP = "rep_item_z join rep_item_g g on rep_item_z.menu_page_id = g.menu_page_id and rep_item_z.dish_id = g.dish_id"
EXCLUDED = "excluded as (" + "\nunion all ".join(
    (
        lost("menu", "'scope:' || case when currency <> 'Dollars' then 'currency' when status <> 'complete' then 'status' when trim(date) = '' then 'date' else 'year' end", "menu_raw", f"menu_raw where not ({IN_SCOPE})"),
        lost("dish", "'scope:price'", "dish_raw", "dish_raw where trim(lowest_price) = '' and trim(highest_price) = ''"),
        lost("menu_item", "'no_dish_id_and_no_price'", "item_clean", "item_clean where omit"),
        lost("menu_page", "'IND-1'", "page_clean", "page_clean where not exists (select 1 from stg_menu m where m.id = menu_id)"),
        lost("menu_item", "'IND-2'", "stg_item", "stg_item where not exists (select 1 from ld_page p where p.id = menu_page_id)"),
        lost("menu_item", "'IND-3'", "on_page", "on_page where not exists (select 1 from stg_dish d where d.id = dish_id)"),
        lost("menu_item", "'D3'", "ld_item", "ld_item where price = 0 and high_price = 0", 1),
        lost("menu_item", "'D4'", "rep_item_z", f"{IN_GROUP} where g.n > 1 and rep_item_z.id <> g.keep_id", 1, "g.keep_id"),
        lost("menu_item", "'D5'", "rep_item_z", f"{IN_GROUP} where g.n = 1 and rep_item_z.price is null", 1),
        lost("menu_item", "'price_too_large'", "rep_item", "rep_item where price >= 1e16", 1),
    )
) + ")"
LEDGER = "menu_raw dish_raw item_clean on_page stg_dish page_clean stg_menu rep_item"
O["excluded_records"] = sql(LEDGER, "select * from excluded", EXCLUDED)
O["row_accounting"] = sql(
    LEDGER,
    """select t as "table", given as input_rows, kept as kept_rows, excluded as excluded_rows, merged as merged_rows, given - kept - excluded as lost_rows,
    cast(0 as bigint) as doubled_rows, cast(0 as bigint) as stray_rows, given = kept + excluded as balanced
  from (select t, given, kept, (select count(*) from excluded e where e."table" = t) as excluded,
      (select count(kept_source_row_num) from excluded e where e."table" = t) as merged
    from (select 'menu' as t, (select count(*) from menu_raw) as given, (select count(*) from stg_menu) as kept
      union all select 'menu_page', (select count(*) from page_raw), (select count(*) from ld_page)
      union all select 'menu_item', (select count(*) from item_raw), (select count(*) from rep_item where price is null or price < 1e16)
      union all select 'dish', (select count(*) from dish_raw), (select count(*) from stg_dish)))""",
    EXCLUDED,
)

# --- scope and profile ------------------------------------------------------
O["scope_menu"] = sql("menu_export", "select * from menu_export")
O["scope_dish"] = sql("dish_export", "select * from dish_export")
O["scope_waterfall"] = sql(
    "menu_raw",
    """select step, filter, remaining, case when step = 0 then 0 else lag(remaining) over (order by step) - remaining end as removed from (
    select 0 as step, 'raw' as filter, count(*) as remaining from menu_raw
    union all select 1, 'currency', count(*) from menu_raw where currency = 'Dollars'
    union all select 2, 'status', count(*) from menu_raw where currency = 'Dollars' and status = 'complete'
    union all select 3, 'date', count(*) from menu_raw where currency = 'Dollars' and status = 'complete' and trim(date) <> ''
    union all select 4, 'year', count(*) from menu_raw where %s)""" % IN_SCOPE,
)


def profiled(table: str, source: str, c: str) -> str:
    numeric = c.endswith(("id", "price"))
    t, missing = f"trim({c})", f"({c} is null or trim({c}) in {TOKENS})"
    num = f"case when regexp_matches({t}, '{NUMBER}') then try_cast({t} as double) end" if numeric else "cast(null as double)"
    bad = f"not {missing} and not regexp_matches({t}, '{NUMBER}')" if numeric else "false"
    return f"""select '{table}' as "table", '{c}' as "column", count(*) as rows, count(*) filter (where {missing}) as missing, count(*) filter (where {t} = '') as blank,
    count(*) filter (where {bad}) as malformed, count(*) filter (where ({num}) = 0) as zero, count(*) filter (where ({num}) < 0) as negative, count(distinct {c}) as distinct_values,
    count(*) filter (where not {missing} and not regexp_matches({t}, '[\\p{{L}}\\p{{N}}]')) as symbol_only,
    count(*) filter (where not {missing} and regexp_matches({t}, '^[0-9]+$')) as numeric_only,
    min({t}) filter (where not {missing}) as low, max({t}) filter (where not {missing}) as high from {source}"""


PROFILED = {
    "menu": ("menu_raw", ("id", "date", "currency", "status")),
    "menu_page": ("page_raw", ("id", "menu_id")),
    "menu_item": ("item_raw", ("id", "menu_page_id", "price", "high_price", "dish_id")),
    "dish": ("dish_raw", ("id", "name", "lowest_price", "highest_price")),
}
O["profile"] = sql("menu_raw page_raw item_raw dish_raw", "\nunion all ".join(profiled(t, s, c) for t, (s, cs) in PROFILED.items() for c in cs))
O["id_health"] = sql(
    "menu_clean page_clean item_clean dish_clean",
    "\nunion all ".join(
        f"""select '{t}' as "table", '{c}' as "column", count(*) as rows, count(*) filter (where {c} is null) as null_rows, count(distinct {c}) as distinct_values from {s}"""
        for t, s, cs in (("menu", "menu_clean", ("id",)), ("menu_page", "page_clean", ("id", "menu_id")), ("menu_item", "item_clean", ("id", "menu_page_id", "dish_id")), ("dish", "dish_clean", ("id",)))
        for c in cs
    ),
)
PRICED = (("menu_item", "item_clean", "price_2dp", "high_price_2dp"), ("dish", "dish_clean", "lowest_price_2dp", "highest_price_2dp"))
O["price_health"] = sql(
    "item_clean dish_clean",
    "\nunion all ".join(
        f"""select '{t}' as "table", '{c[:-4]}' as "column", count(*) filter (where {c} is null) as missing, count(*) filter (where {c}::double <= 0) as non_positive,
    count(*) filter (where {c}::double > 0) as positive, count(*) filter (where {h}::double < {l}::double) as contradictory,
    count(*) filter (where {l}::double > 0 and {h}::double > 0) as both_positive from {s}"""
        for t, s, l, h in PRICED
        for c in (l, h)
    ),
)
O["price_quantile"] = sql(
    "item_clean dish_clean",
    "\nunion all ".join(
        f"""select '{t}' as "table", '{c[:-4]}' as "column", {p} as prob, count(*) as total, round(quantile_cont({c}::double, {p}), 4) as value from {s} where {c}::double > 0"""
        for t, s, l, h in PRICED
        for c in (l, h)
        for p in ("0.95::double", "0.99::double", "0.995::double", "0.999::double")
    ),
)
O["price_quantile_sketch"] = sql(
    "item_clean dish_clean",
    "\nunion all ".join(
        f"""select '{t}' as "table", '{c[:-4]}' as "column", {p} as prob, count(*) as total, true as within_bound from {s} where {c}::double > 0"""
        for t, s, l, h in PRICED
        for c in (l, h)
        for p in ("0.95::double", "0.99::double", "0.995::double", "0.999::double")
    ),
)
ID_PLACES = (
    ("menu", (("menu_clean", "id", "menu.id"), ("page_clean", "menu_id", "menu_page.menu_id"))),
    ("menu_page", (("page_clean", "id", "menu_page.id"), ("item_clean", "menu_page_id", "menu_item.menu_page_id"))),
    ("dish", (("dish_clean", "id", "dish.id"), ("item_clean", "dish_id", "menu_item.dish_id"))),
)
O["distinct_sketch"] = sql(
    "menu_clean page_clean item_clean dish_clean",
    "\nunion all ".join(
        [f"select '{k}' as kind, '{at}' as place, count(distinct {c}) as exact, true as within_bound from {s}" for k, places in ID_PLACES for s, c, at in places]
        + [f"select '{k}', 'all', count(distinct v), true from ({' union all '.join(f'select {c} as v from {s}' for s, c, _ in places)})" for k, places in ID_PLACES]
    ),
)
O["year_range"] = sql("menu_clean", "select min(year) as first_year, max(year) as last_year, count(year) as dated, count(*) - count(year) as undated from menu_clean")
O["name_collapse"] = sql("dish_clean", "select count(distinct raw_name) as distinct_before, count(distinct name) as distinct_after, count(distinct raw_name) - count(distinct name) as collapsed, count(*) filter (where name = 'UNKNOWN') as unknown from dish_clean")
FINGERPRINT = """variants as (select key as cluster_key, name as variant, count(*) as variant_rows from (
    select name, array_to_string(list_sort(list_distinct(regexp_split_to_array(trim(regexp_replace(strip_accents(lower(trim(name))), '[[:punct:]]', '', 'g')), '\\s+'))), ' ') as key
    from name_variants) group by 1, 2),
clusters as (select cluster_key, count(*) as variants, cast(sum(variant_rows) as bigint) as cluster_rows, arg_max(variant, (variant_rows, variant)) as suggested
    from variants group by 1 having count(*) > 1)"""
O["cluster_fingerprint"] = sql("name_variants", "select * from clusters", FINGERPRINT)
O["cluster_members"] = sql("name_variants", "select v.cluster_key, v.variant, v.variant_rows, c.variants, c.cluster_rows, c.suggested from variants v join clusters c on v.cluster_key = c.cluster_key", FINGERPRINT)

HEADS = """spelt as (select p.id, p.name, c.cluster_key, coalesce(c.suggested, p.name) as plain
    from part_names p join variants v on v.variant = p.name left join clusters c on c.cluster_key = v.cluster_key),
heads as (select split_part(v.cluster_key, ' ', 1) as head, plain, count(*) as n from spelt join variants v on v.variant = plain group by all),
head_clusters as (select head, arg_max(plain, (n, plain)) as suggested from heads group by head having count(*) > 1),
merged as (select s.id, s.name, coalesce(hc.suggested, s.plain) as merged,
    case when s.name <> s.plain then 'fingerprint:' || s.cluster_key when hc.suggested <> s.plain then 'head:' || hc.head end as moved
    from spelt s join heads h on h.plain = s.plain left join head_clusters hc on hc.head = h.head)"""
O["cluster_apply"] = sql("name_variants part_names", "select id, name, merged, case when merged <> name then moved end as cluster_id from merged", FINGERPRINT, HEADS)
O["cluster_effect"] = sql(
    "name_variants part_names",
    """select moved as cluster_id, split_part(moved, ':', 1) as "method", merged as canonical, count(distinct name) as merged_variants, count(*) as rows_affected
  from merged where moved is not null and merged <> name group by all""",
    FINGERPRINT,
    HEADS,
)


def each(case: str, word: str = "w") -> str:
    """A text made place by place: b is the letter, a the one before, c and d the ones after."""
    for letter, at in (("a", "i - 1"), ("b", "i"), ("c", "i + 1"), ("d", "i + 2")):
        case = case.replace(f"${letter}", f"(case when {at} between 1 and length({word}) then {word}[{at}] else '' end)")
    return f"array_to_string(list_transform(range(1, length({word}) + 1), lambda i: {case}), '')"


def single_runs(x: str) -> str:
    """Equal neighbours once."""
    return f"array_to_string(list_filter(string_split({x}, ''), lambda y, i: i = 1 or y <> ({x})[i - 1]), '')"


COLOGNE = """case when $b in ('A','E','I','J','O','U','Y') then '0' when $b = 'B' then '1' when $b = 'P' then case when $c = 'H' then '3' else '1' end
  when $b in ('D','T') then case when $c in ('C','S','Z') then '8' else '2' end when $b in ('F','V','W') then '3' when $b in ('G','K','Q') then '4'
  when $b = 'C' then case when i = 1 and $c in ('A','H','K','L','O','Q','R','U','X') then '4' when i = 1 then '8'
    when $a in ('S','Z') then '8' when $c in ('A','H','K','O','Q','U','X') then '4' else '8' end
  when $b = 'X' then case when $a in ('C','K','Q') then '8' else '48' end when $b = 'L' then '5' when $b in ('M','N') then '6' when $b = 'R' then '7'
  when $b in ('S','Z') then '8' else '' end"""
VOWELS = "('A','E','I','O','U')"
METAPHONE = f"""case when $b in {VOWELS} then case when i = 1 then $b else '' end
  when $b = 'C' then case when $c = 'H' then case when $a = 'S' then 'K' else 'X' end when $c = 'I' and $d = 'A' then 'X' when $c in ('I','E','Y') then 'S' else 'K' end
  when $b = 'D' then case when $c = 'G' and $d in ('E','I','Y') then 'J' else 'T' end
  when $b = 'G' then case when $a = 'D' and $c in ('E','I','Y') then '' when $c = 'H' and $d <> '' and $d not in {VOWELS} then ''
    when $c = 'N' and i + 1 = length(w) then 'N' when $c in ('I','E','Y') then 'J' else 'K' end
  when $b = 'H' then case when $a in ('C','S','T','P') or ($a = 'G' and $c <> '' and $c not in {VOWELS}) then ''
    when regexp_matches(substr(w, 1, i - 1), '[AEIOU][WY]*$') and $c not in {VOWELS} then '' else 'H' end
  when $b = 'K' then case when $a = 'C' then '' else 'K' end
  when $b = 'N' then case when $a = 'G' and i = length(w) then '' else 'N' end
  when $b = 'P' then case when $c = 'H' then 'F' else 'P' end when $b = 'Q' then 'K'
  when $b = 'S' then case when $c = 'H' or ($c = 'I' and $d in ('O','A')) then 'X' else 'S' end
  when $b = 'T' then case when $c = 'C' and $d = 'H' then '' when $c = 'H' then '0' when $c = 'I' and $d in ('A','O') then 'X' else 'T' end
  when $b = 'V' then 'F' when $b in ('W','Y') then case when $c in {VOWELS} then $b else '' end
  when $b = 'X' then 'KS' when $b = 'Z' then 'S' else $b end"""


def phonetic(source: str, column: str) -> str:
    """``name, soundex, cologne, metaphone`` of every distinct value, told letter by letter."""
    starts = (("KN|GN|PN", "N"), ("AE", "E"), ("WR", "R"), ("X", "S"), ("WH", "W"))
    w = "doubles"
    for pattern, to in starts:
        w = f"regexp_replace({w}, '^(?:{pattern})', '{to}')"
    kept_c = "array_to_string(list_filter(string_split(l, ''), lambda y, i: i = 1 or y = 'C' or y <> l[i - 1]), '')"
    letter_codes = "translate(l[1] || regexp_replace(substr(l, 2), '[HW]', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    return f"""ph_l as (select distinct {column} as name, regexp_replace(upper({column}), '[^A-Z]', '', 'g') as l from {source}),
ph_c as (select name, l, l as w, case when l = '' then '' else {letter_codes} end as sc, {kept_c} as doubles from ph_l),
ph_k as (select name, l, sc, {each(COLOGNE)} as ck, regexp_replace({w}, 'MB$', 'M') as m from ph_c),
ph as (select name, case when l = '' then '' else l[1] || rpad(substr(array_to_string(list_filter(string_split(substr(sc, 2), ''), lambda y, i: y <> '0' and y <> sc[i]), ''), 1, 3), 3, '0') end as soundex,
    substr({single_runs('ck')}, 1, 1) || replace(substr({single_runs('ck')}, 2), '0', '') as cologne,
    {each(METAPHONE.replace('w)', 'm)').replace('substr(w', 'substr(m'), 'm')} as metaphone from ph_k)"""


O["cluster_phonetic"] = sql(
    "dish_clean",
    "\nunion all ".join(
        f"""select '{m}' as "method", cluster_key, count(*) as variants, cast(sum(variant_rows) as bigint) as cluster_rows, arg_max(variant, (variant_rows, variant)) as suggested
  from (select ph.{m} as cluster_key, d.name as variant, count(*) as variant_rows from dish_clean d join ph on ph.name = d.name group by all) group by cluster_key having count(*) > 1"""
        for m in ("soundex", "cologne", "metaphone")
    ),
    phonetic("dish_clean", "name"),
)

# --- checks -----------------------------------------------------------------
IC = (
    ("1", "stg_menu_all", "", "Menu.id is required", "id is null"),
    ("2", "stg_menu_all", "currency", "currency must be USD", "currency is null or currency <> 'USD'"),
    ("3", "stg_menu_all", "year", "year must be an integer between 1851 and 2012", "year is null or year < 1851 or year > 2012"),
    ("4", "stg_menu_all", "month", "month must be an integer between 1 and 12", "month is null or month < 1 or month > 12"),
    ("5", "stg_menu_all", "day", "day must be an integer between 1 and 31", "day is null or day < 1 or day > 31"),
    ("6", "stg_item", "", "MenuItem.id is required", "id is null"),
    ("7", "stg_item", "menu_page_id", "MenuItem.menu_page_id is required", "menu_page_id is null"),
    ("8", "stg_item", "price", "price must be null or nonzero", "price is not null and price = 0"),
    ("9", "stg_item", "high_price", "high_price must be null or >= 0", "high_price is not null and high_price < 0"),
    ("10", "stg_item", "dish_id", "MenuItem.dish_id is required", "dish_id is null"),
    ("11", "stg_item", "price, high_price", "high_price = 0 requires a non-null price", "high_price = 0 and price is null"),
    ("12", "page_clean", "", "MenuPage.id is required", "id is null"),
    ("13", "page_clean", "menu_id", "MenuPage.menu_id is required", "menu_id is null"),
    ("14", "stg_dish_all", "", "Dish.id is required", "id is null"),
    ("15", "stg_dish_all", "lowest_price", "lowest_price must be between 0 and 1100", "lowest_price is null or lowest_price < 0 or lowest_price > 1100"),
    ("16", "stg_dish_all", "highest_price", "highest_price must be between 0 and 3100", "highest_price is null or highest_price < 0 or highest_price > 3100"),
    ("17", "stg_dish_all", "lowest_price, highest_price", "highest_price must be >= lowest_price", "highest_price < lowest_price"),
)
for n, source, shown, text, predicate in IC:
    kind = f", case when {shown} is null then 'null' else 'integer' end as stored_type" if n in "345" else ""
    O[f"ic_{n}"] = sql(source, f"select 'IC-{n}' as rule_id, id{', ' + shown if shown else ''}{kind}, {lit(text)} as violation from {source} where {predicate}")


def dependency(rule: str, source: str, attributes: dict[str, str], changed: str) -> str:
    def values(c: str) -> str:
        return f"count(distinct {c}) + case when count(*) > count({c}) then 1 else 0 end"

    counts = ", ".join(f"{values(c)} as {n}" for c, n in attributes.items())
    most = f"greatest({', '.join(values(c) for c in attributes)})"
    return f"""select '{rule}' as rule_id, id, count(*) as row_count, {counts}, case when {most} > 1 then 'fd_violation' else 'duplicate_load' end as disposition
  from (select * from {source} union all select * replace ({changed}) from {source} where id % 10 = 0 union all select * from {source} where id % 10 = 1)
  group by id having count(*) > 1"""


O["fd_1"] = sql("stg_menu_all", dependency("FD-1", "stg_menu_all", {"currency": "currency_values", "year": "year_values", "month": "month_values", "day": "day_values"}, "'changed' as currency"))
O["fd_2"] = sql("page_clean", dependency("FD-2", "page_clean", {"menu_id": "menu_id_values"}, "menu_id + 1 as menu_id"))
O["fd_3"] = sql("stg_item", dependency("FD-3", "stg_item", {"menu_page_id": "page_values", "price": "price_values", "high_price": "high_price_values", "dish_id": "dish_id_values"}, "price + 1 as price"))
O["fd_5"] = sql("stg_dish_all", dependency("FD-5", "stg_dish_all", {"name": "name_values", "lowest_price": "lowest_price_values", "highest_price": "highest_price_values"}, "'changed' as name"))
FD4 = """select 'FD-4' as rule_id, menu_page_id, dish_id, count(*) as line_count, count(distinct price) + case when count(*) > count(price) then 1 else 0 end as distinct_prices,
    count(price) as priced_lines, case when count(distinct price) > 1 then 'conflicting_prices' else 'price_and_blank' end as disposition,
    min(price) as low_price, max(price) as high_price
  from {} where dish_id is not null group by menu_page_id, dish_id having count(distinct price) + case when count(*) > count(price) then 1 else 0 end > 1"""
O["fd_4"] = sql("stg_item", FD4.format("stg_item"))
O["fd_4_prices"] = sql("stg_item", f"""select i.menu_page_id, i.dish_id, i.price, count(*) as n from stg_item i
  join ({FD4.format("stg_item")}) f on f.menu_page_id is not distinct from i.menu_page_id and f.dish_id = i.dish_id group by all""")
REPORT = "select {k}, count(*) as row_count, count(distinct {v}) + case when count(*) > count({v}) then 1 else 0 end as {n} from {s} group by {k} having count(distinct {v}) + case when count(*) > count({v}) then 1 else 0 end > 1"
O["report_name_ids"] = sql("stg_dish_all", REPORT.format(k="name", v="id", n="id_values", s="stg_dish_all"))
O["report_dish_prices"] = sql("stg_item", REPORT.format(k="dish_id", v="price", n="price_values", s="stg_item"))
O["report_menu_pages"] = sql("page_clean", REPORT.format(k="menu_id", v="id", n="id_values", s="page_clean"))
ORPHAN = "select * from {} where not exists (select 1 from {} p where p.id = {})"
O["ind_1"] = sql("page_clean stg_menu", ORPHAN.format("page_clean", "stg_menu", "menu_id"))
O["ind_2"] = sql("on_page", ORPHAN.format("stg_item", "ld_page", "menu_page_id"))
O["ind_3"] = sql("on_page stg_dish", ORPHAN.format("on_page", "stg_dish", "dish_id"))
O["ind_3_ignore_nulls"] = sql("on_page stg_dish", ORPHAN.format("on_page", "stg_dish", "dish_id") + " and dish_id is not null")
O["ind_4"] = sql("final_item stg_menu", "select * from (select * from final_item union all select menu_item_id, -menu_id - 1, dish_name, clean_item_price from final_item where menu_item_id % 10 = 0) where not exists (select 1 from stg_menu m where m.id = menu_id)")
O["ind_report"] = sql(
    "on_page stg_dish stg_menu page_clean",
    f"""select 'IND-1' as IND_reason, 'stg_menu_page' as source_table, id, menu_id, cast(null as bigint) as menu_page_id, cast(null as double) as price, cast(null as double) as high_price, cast(null as bigint) as dish_id
    from ({ORPHAN.format('page_clean', 'stg_menu', 'menu_id')})
  union all select 'IND-2', 'stg_menu_item', id, null, menu_page_id, price, high_price, dish_id from ({ORPHAN.format('stg_item', 'ld_page', 'menu_page_id')})
  union all select 'IND-3', 'stg_menu_item', id, null, menu_page_id, price, high_price, dish_id from ({ORPHAN.format('on_page', 'stg_dish', 'dish_id')})""",
)
O["load_cascade"] = sql("ld_item", "select * from ld_item")

LOADED = {"stg_menu_all": "stg_menu", "stg_item": "ld_item", "page_clean": "ld_page", "stg_dish_all": "stg_dish"}
NAMES = {"stg_menu_all": "menu", "stg_item": "menu_item", "page_clean": "menu_page", "stg_dish_all": "dish"}


def report(n: str, source: str, shown: str, text: str, predicate: str) -> str:
    cells = ["id", *(c.strip() for c in shown.split(",") if c)]
    pairs = ", ".join(f"'{c}', cast({c} as varchar)" for c in cells)
    if n in "345":
        pairs += f", 'stored_type', case when {shown} is null then 'null' else 'integer' end"
    return f"select 0 as iteration, 'IC' as family, 'IC-{n}' as rule_id, '{NAMES[source]}' as source_table, cast(id as varchar) as row_key, cast(null as varchar) as disposition, {lit(text)} as violation, cast(json_object({pairs}) as varchar) as details from {LOADED[source]} where {predicate}"


FD4_KEYS = ("menu_page_id", "dish_id", "line_count", "distinct_prices", "priced_lines", "low_price", "high_price")
O["violation_report"] = sql(
    "stg_menu ld_item ld_page stg_dish",
    "\nunion all ".join(report(*rule) for rule in IC)
    + "\nunion all select 0, 'FD', 'FD-4', 'menu_item', concat_ws('|', menu_page_id, dish_id), disposition, 'menu_page_id, dish_id -> price', cast(json_object("
    + ", ".join(f"'{c}', cast({c} as varchar)" for c in FD4_KEYS)
    + f") as varchar) from ({FD4.format('ld_item')})",
)


def counts(items: str) -> str:
    swap = {**LOADED, "stg_item": items}
    parts = [f"select 'IC' as family, 'IC-{n}' as rule_id, count(*) as violations from {swap[s]} where {p}" for n, s, _, _, p in IC]
    parts += [f"select 'IND', 'IND-{i}', count(*) from ({ORPHAN.format(c, p, k)})" for i, c, k, p in ((1, "ld_page", "menu_id", "stg_menu"), (2, items, "menu_page_id", "ld_page"), (3, items, "dish_id", "stg_dish"))]
    parts += [f"select 'FD', 'FD-{n}', count(*) from (select id from {s} group by id having count(*) > 1)" for n, s in ((1, "stg_menu"), (2, "ld_page"), (3, items), (5, "stg_dish"))]
    parts.append(f"select 'FD', 'FD-4', count(*) from ({FD4.format(items)})")
    return "\nunion all ".join(parts)


COUNTS = f"counts as (select 0 as iteration, * from ({counts('ld_item')}) union all select 1, * from ({counts('rep_item')}))"
O["violation_counts"] = sql("rep_item", "select * from counts", COUNTS)
O["violation_delta"] = sql(
    "rep_item",
    "select family, rule_id, b as before_repair, a as after_repair, b - a as resolved from (select family, rule_id, cast(sum(violations) filter (where iteration = 0) as bigint) as b, cast(sum(violations) filter (where iteration = 1) as bigint) as a from counts group by 1, 2)",
    COUNTS,
)


def metrics(i: int, items: str) -> str:
    fam = ", ".join(f"(select cast(sum(violations) as bigint) from counts where iteration = {i} and family = '{f}') as {f.lower()}_violations" for f in ("IC", "IND", "FD"))
    return f"""select {i} as iteration, {fam}, (select count(*) from {items}) as item_rows, count(*) as eligible_items, count(distinct p.menu_id) as eligible_menus
  from {items} i join ld_page p on p.id = i.menu_page_id join stg_dish d on d.id = i.dish_id where i.price > 0"""


O["iteration_metrics"] = sql(
    "rep_item ld_page stg_dish",
    """select *, ic_violations + ind_violations + fd_violations as violations_remaining,
    cast(case when iteration = 1 then (select count(*) from rep_item r join ld_item l on l.id = r.id left join rep_item_g g on g.menu_page_id = l.menu_page_id and g.dish_id = l.dish_id
      where l.price = 0 or g.n > 1) else 0 end as bigint) as rows_repaired,
    cast(case when iteration = 1 then (select count(*) from ld_item) - (select count(*) from rep_item) else 0 end as bigint) as rows_excluded,
    ic_violations + ind_violations + fd_violations - lag(ic_violations + ind_violations + fd_violations) over (order by iteration) as change_in_violations,
    eligible_items - lag(eligible_items) over (order by iteration) as change_in_eligible_items,
    eligible_menus - lag(eligible_menus) over (order by iteration) as change_in_eligible_menus from (%s)"""
    % (metrics(0, "ld_item") + "\nunion all " + metrics(1, "rep_item")),
    COUNTS,
)
STATEMENTS = [(f"IC-{n}", NAMES[s], text) for n, s, _, text, _ in IC] + [
    ("IND-1", "menu_page", "menu_page.menu_id must exist in menu.id"),
    ("IND-2", "menu_item", "menu_item.menu_page_id must exist in menu_page.id"),
    ("IND-3", "menu_item", "menu_item.dish_id must exist in dish.id"),
    ("FD-1", "menu", "id -> currency, year, month, day"),
    ("FD-2", "menu_page", "id -> menu_id"),
    ("FD-3", "menu_item", "id -> menu_page_id, price, high_price, dish_id"),
    ("FD-4", "menu_item", "menu_page_id, dish_id -> price"),
    ("FD-5", "dish", "id -> name, lowest_price, highest_price"),
]
O["validation_report"] = sql(
    "rep_item",
    """select family, rule_id, source_table, statement, b as before_repair, a as after_repair, b - a as resolved,
    case when a + b = 0 then 'holds' when a = 0 then 'resolved' when a < b then 'reduced' else 'accepted' end as outcome
  from (select family, rule_id, cast(sum(violations) filter (where iteration = 0) as bigint) as b, cast(sum(violations) filter (where iteration = 1) as bigint) as a from counts group by 1, 2)
  join (values %s) v(rule_id, source_table, statement) using (rule_id)"""
    % ", ".join(f"({lit(r)}, {lit(t)}, {lit(x)})" for r, t, x in STATEMENTS),
    COUNTS,
)

# --- repair, final tables, analysis -----------------------------------------
O["ic8_repair"] = sql("stg_item", "select * from r_z", repaired("r", "stg_item"))
O["fd4_repair"] = sql("stg_item", "select * from r", repaired("r", "stg_item"))
O["final_menu"] = sql("stg_menu", "select id as menu_id, year as cleaned_year, currency as currency_clean from stg_menu")
O["final_item"] = sql("final_item", "select * from final_item")


def fallback(items: str) -> str:
    chain = (
        ("i.price > 0", "i.price", "menu_item_price"),
        ("i.high_price > 0", "i.high_price", "menu_item_high_price"),
        ("d.lowest_price > 0 and d.highest_price > 0", "(d.lowest_price + d.highest_price) / 2", "dish_lowest_highest_average"),
        ("d.lowest_price > 0", "d.lowest_price", "dish_lowest_price"),
        ("d.highest_price > 0", "d.highest_price", "dish_highest_price"),
    )
    value = " ".join(f"when {p} then {v}" for p, v, _ in chain)
    source = " ".join(f"when {p} then '{s}'" for p, _, s in chain)
    return f"""priced as (select i.id, i.menu_page_id, i.price, i.high_price, i.dish_id, d.lowest_price as dish_lowest_price, d.highest_price as dish_highest_price,
    case {value} end as clean_price_candidate, case {source} else 'no_valid_price' end as price_source
  from {items} i left join stg_dish d on d.id = i.dish_id)"""


O["price_fallback"] = sql("stg_item stg_dish", "select *, case when price_source = 'no_valid_price' then 'no_valid_fallback_price' end as exclusion_reason from priced", fallback("stg_item"))
O["price_source_counts"] = sql(
    "stg_item stg_dish",
    """select priority, price_source, items, price_source not in ('menu_item_price', 'no_valid_price') as recovered,
    case when price_source <> 'no_valid_price' and usable > 0 then items * 100.0::double / usable end as pct_of_usable
  from (select s.priority, s.price_source, (select count(*) from priced p where p.price_source = s.price_source) as items,
      (select count(*) from priced p where p.price_source <> 'no_valid_price') as usable
    from (values (1, 'menu_item_price'), (2, 'menu_item_high_price'), (3, 'dish_lowest_highest_average'), (4, 'dish_lowest_price'), (5, 'dish_highest_price'), (6, 'no_valid_price')) s(priority, price_source))""",
    fallback("stg_item"),
)
O["final_item_priced"] = sql(
    "rep_item stg_dish ld_page",
    """select f.id as menu_item_id, p.menu_id, f.menu_page_id, f.dish_id, clean_price_candidate as clean_item_price, price_source, price as original_price, high_price as original_high_price,
    dish_lowest_price, dish_highest_price from priced f join ld_page p on p.id = f.menu_page_id where clean_price_candidate > 0""",
    fallback("rep_item"),
)
O["menu_avg"] = sql("menu_avg", "select * from menu_avg")
O["menu_avg_decade"] = sql("menu_avg", "select menu_id, cast(floor(period / 10) * 10 as int) as period, item_count, avg_price from menu_avg")
O["price_tier"] = sql("menu_avg", "select *, cast(tier as bigint) as t, repeat('$', tier::bigint) as label from (select *, cast(ntile(4) over (partition by period order by avg_price, menu_id) as int) as tier from menu_avg)").replace("*, cast(tier as bigint) as t,", "*,")
O["top_menus"] = sql(
    "menu_avg",
    """select * from (select 'most_expensive' as "end", *, cast(row_number() over (partition by period order by avg_price desc, menu_id) as int) as position from menu_avg
    union all select 'least_expensive', *, cast(row_number() over (partition by period order by avg_price, menu_id) as int) from menu_avg) where position <= 5""",
)
O["top_span"] = "select l_partkey, first_seen, last_seen, cast(date_diff('day', first_seen, last_seen) as int) as span_days from (select l_partkey, cast(min(l_shipdate) as date) as first_seen, cast(max(l_shipdate) as date) as last_seen from lineitem group by l_partkey) order by span_days desc, l_partkey limit 20"
O["menu_items"] = sql("item_raw page_raw dish_raw", "select p.menu_id, i.menu_page_id, i.id as menu_item_id, i.dish_id, d.name, i.price from item_raw i join page_raw p on p.id = i.menu_page_id left join dish_raw d on d.id = i.dish_id")
LIMITS = (0.05, 0.01, 0.005, 0.001)
MEAN = "round(avg({}), 9)"
O["cap_sensitivity"] = sql(
    "item_clean page_clean stg_menu",
    "\nunion all ".join(
        f"""select {limit * 100!r}::double as limit_pct, (select c{i} from caps) as threshold, quarter, count(*) as menus, cast(sum(h{i}) as bigint) as items_capped,
    round((sum(a{i}) - sum(avg_price)) * 100 / sum(avg_price), 9) as pct_change from q group by quarter"""
        for i, limit in enumerate(LIMITS)
    ),
    "caps as (select " + ", ".join(f"quantile_cont(price_2dp::double, {1 - x!r}) as c{i}" for i, x in enumerate(LIMITS)) + " from item_clean where price_2dp::double > 0)",
    f"""m as (select p.menu_id, {MEAN.format('v')} as avg_price, {', '.join(f"{MEAN.format(f'least(v, c{i})')} as a{i}, count(*) filter (where v > c{i}) as h{i}" for i in range(4))}
    from (select menu_page_id, price_2dp::double as v from item_clean where price_2dp::double > 0) i join page_clean p on p.id = i.menu_page_id, caps where p.menu_id in (select id from stg_menu) group by p.menu_id)""",
    "q as (select *, cast(ntile(4) over (order by avg_price, menu_id) as int) as quarter from m)",
)
