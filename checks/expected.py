"""SQL counterparts of the queries, written from the definitions and straight from the rows.

They share only the derivation of the transactions with the Spark side: no cells, no roll-ups, no
staged percentiles.
"""

from __future__ import annotations

from deedmill.config import (
    AGE_PATTERN, BEDROOM_METRICS, COMMERCIAL_TYPES, DEFAULTS, EXPECTED_COLUMNS, FLOOR_NUMBERS, NON_BHK_LABELS, PARAM_COLUMNS, RESIDENTIAL_TYPES,
)
from deedmill.sources import star

RES, COM = (", ".join(f"'{x}'" for x in names) for names in (RESIDENTIAL_TYPES, COMMERCIAL_TYPES))
AGE = AGE_PATTERN


def _values(rows) -> str:
    def text(v) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


def _tables() -> str:
    params = [(c, *(float(getattr(p, n)) for n in PARAM_COLUMNS)) for c, p in DEFAULTS.cities.items()]
    return f"""
floors(name, number) AS (VALUES {_values(FLOOR_NUMBERS.items())}),
bhk_map(k, v) AS (VALUES {_values((k.lower(), v) for k, v in star.BHK_LABELS.items())}),
type_map(k, v) AS (VALUES {_values((k.lower(), v) for k, v in star.PROPERTY_LABELS.items())}),
city_over(city, {", ".join(PARAM_COLUMNS)}) AS (VALUES {_values(params)})"""


def _param(name: str) -> str:
    return f"coalesce(o.{name}, {float(getattr(DEFAULTS.default_city, name))!r}::DOUBLE)::DOUBLE"


OWN_LEVELS = {
    "micro": "UNION ALL SELECT 'micro', CAST(location_id AS BIGINT), * FROM p WHERE location_id IS NOT NULL",
    "pair": "UNION ALL SELECT 'pair', CAST(dense_rank() OVER (ORDER BY location, project_type) AS BIGINT), * FROM p "
    "WHERE location IS NOT NULL AND project_type IS NOT NULL",
}


def _prepared(level: str = "") -> str:
    own_level = OWN_LEVELS.get(level, "")
    loading = f"CASE WHEN t.property_type IN ('Flat', 'Others') THEN {_param('residential_loading')} ELSE {_param('commercial_loading')} END"
    bounds = ", ".join(f"{_param(c)} AS {c}" for c in PARAM_COLUMNS if c.startswith(("min_", "max_")))
    return f"""
t AS ({star.transactions_sql()}),{_tables()},
p0 AS (
  SELECT t.* EXCLUDE (floor_no, bhk_br, property_type_raw, agreement_price, buyer_pincode, project_type, purchaser_name),
    t.property_type_raw AS type_entered, t.bhk_br AS bhk_entered, t.floor_no AS floor_entered, t.agreement_price AS price_entered,
    CASE WHEN f.name IS NOT NULL THEN f.number::DOUBLE ELSE CAST(t.floor_no AS DOUBLE) END AS floor_no,
    b.v AS bhk_br,
    m.v AS property_type_raw,
    CASE WHEN t.property_category = 'Sale' THEN TRY_CAST(t.agreement_price AS DOUBLE) END AS agreement_price,
    TRY_CAST(t.buyer_pincode AS DOUBLE) AS buyer_pincode,
    CASE WHEN t.project_type IS NULL OR trim(t.project_type) = '' THEN
      CASE WHEN t.property_type_raw IN ({RES}) THEN 'Residential' WHEN t.property_type_raw IN ({COM}) THEN 'Commercial' ELSE 'Other' END
      ELSE t.project_type END AS project_type,
    list_filter(list_transform(
      string_split_regex(t.purchaser_name, '\\s*\\d+\\)\\s*')[2:],
      lambda x: TRY_CAST(regexp_extract(regexp_extract(x, '{AGE}', 0), '\\d\\d', 0) AS INTEGER)), lambda a: a > 0) AS age,
    nullif(t.net_carpet_area_sqmt * 10.764, 0) AS carpet_sqft,
    nullif(t.net_carpet_area_sqmt * ({loading}), 0) AS saleable_sqft,
    {bounds}
  FROM t
  LEFT JOIN floors f ON t.floor_no = f.name
  LEFT JOIN bhk_map b ON lower(trim(t.bhk_br)) = b.k
  LEFT JOIN type_map m ON coalesce(nullif(lower(trim(t.property_type_raw)), ''), 'others') = m.k
  LEFT JOIN city_over o ON t.city = o.city
),
p AS (
  SELECT *, agreement_price / carpet_sqft AS rate_on_net_ca, agreement_price / saleable_sqft AS rate_on_sa FROM p0
),
every AS (
  SELECT 'location' AS level, CAST(loc_id AS BIGINT) AS key_id, * FROM p WHERE loc_id IS NOT NULL
  UNION ALL
  SELECT 'city', CAST(city_id AS BIGINT), * FROM p WHERE city_id IS NOT NULL
  {own_level}
),
sales AS (
  SELECT 'project' AS level, CAST(proj_id AS BIGINT) AS key_id, * FROM p
  WHERE proj_id IS NOT NULL AND property_category = 'Sale' AND manual_processed = 'Yes'
  UNION ALL
  SELECT * FROM every WHERE property_category = 'Sale'
),"""


def _grains(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT *, 'Overall' AS grain, 'Overall' AS period FROM {source}
  UNION ALL SELECT *, 'YoY', CAST("year" AS VARCHAR) FROM {source} WHERE "year" IS NOT NULL
  UNION ALL SELECT *, 'QoQ', "quarter" FROM {source} WHERE "quarter" IS NOT NULL
)"""


PK = "level, city, key_id, grain, period"
SK = f"{PK}, kind, segment"
NON_BHK = ", ".join(f"'{x}'" for x in NON_BHK_LABELS)


def _segments() -> str:
    return f"""
s AS (
  SELECT *, 'property_type' AS kind, property_type AS segment FROM g WHERE property_type IS NOT NULL
  UNION ALL SELECT *, 'bhk_br', bhk_br FROM g WHERE bhk_br IS NOT NULL AND bhk_br NOT IN ({NON_BHK})
)"""


def _with(body: str, *ctes: str) -> str:
    return "WITH" + _prepared() + ",".join(ctes) + "\n" + body


def on_p(body: str) -> str:
    return "WITH" + _prepared().rstrip(",") + "\n" + body


def on_g(body: str) -> str:
    return _with(body, _grains("sales", "g"))


def on_e(body: str) -> str:
    return _with(body, _grains("every", "e"))


def on_s(body: str, *more: str) -> str:
    return _with(body, _grains("sales", "g"), _segments(), *more)


def r2(x: str) -> str:
    """Two decimals, half to even, after dropping the noise of the last bits."""
    return f"(round_even(CAST(CAST({x} AS DECIMAL(38,6)) * 100 AS DOUBLE), 0) / 100)"


def money(x: str) -> str:
    return (
        f"(CASE WHEN {x} >= 1e7 THEN printf('%.2f Cr', ({x}) / 1e7) WHEN {x} >= 1e5 THEN printf('%.2f L', ({x}) / 1e5) "
        f"ELSE printf('%.2f K', ({x}) / 1e3) END)"
    )


def whole(x: str) -> str:
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"


def last(lo: str, hi: str, step: int) -> str:
    return f"({lo} + ceil(({hi} - {lo}) / {step}.0) * {step})"


# --- bucket texts, written as interval look-ups -----------------------------------------------


def span(v: str, lo: str, hi: str, step: int, ends: bool) -> str:
    """Bucket of v in [lo, hi) by steps; with open ends or null beyond."""
    at = f"({lo} + floor(({v} - {lo}) / {step}) * {step})"
    inner = f"{whole(at)} || '-' || {whole(f'{at} + {step}')}"
    if ends:
        return f"(CASE WHEN {v} < {lo} THEN '<' || {whole(lo)} WHEN {v} >= {hi} THEN '>' || {whole(hi)} ELSE {inner} END)"
    return f"(CASE WHEN {v} >= {lo} AND {v} < {hi} THEN {inner} END)"


def price_span(v: str, lo: str, hi: str, step: int) -> str:
    at = f"({lo} + greatest(0, ceil(({v} - {lo}) / {step}) - 1) * {step})"
    return (
        f"(CASE WHEN {v} < {lo} THEN '< ' || {money(lo)} WHEN {v} > {hi} THEN '> ' || {money(hi)} "
        f"ELSE {money(at)} || ' - ' || {money(f'({at} + {step})')} END)"
    )


AREA_ROWS = "net_carpet_area_sqmt > 0 AND carpet_sqft > 0"
AREA_MEAN = f"(round_even(avg(carpet_sqft) OVER (PARTITION BY {SK}) / 100, 0) * 100)"
RATE_MEAN = f"(round_even(avg(rate_on_net_ca) OVER (PARTITION BY {SK}) / 1000, 0) * 1000)"
PRICE_MEAN = f"(round_even(avg(agreement_price) OVER (PARTITION BY {SK}) / 2000000, 0) * 2000000)"


def area_rows(name: str, priced: bool) -> str:
    where = AREA_ROWS + (" AND agreement_price > 0" if priced else "")
    fixed = span("carpet_sqft", "min_area", last("min_area", "max_area", 200), 200, False)
    return f"""
{name}0 AS (SELECT *, {AREA_MEAN} AS m FROM s WHERE {where}),
{name} AS (
  SELECT *, CASE WHEN level = 'project' THEN {span("carpet_sqft", "(m - 400)", "(m + 400)", 200, True)} ELSE {fixed} END AS bucket FROM {name}0
)"""


def rate_rows_(name: str) -> str:
    fixed = span("rate_on_net_ca", "min_rate", last("min_rate", "max_rate", 1000), 1000, True)
    return f"""
{name}0 AS (SELECT *, {RATE_MEAN} AS m FROM s WHERE agreement_price > 0 AND net_carpet_area_sqmt > 0 AND rate_on_net_ca > 0),
{name} AS (
  SELECT *, CASE WHEN level = 'project' THEN {span("rate_on_net_ca", "(m - 3000)", "(m + 3000)", 1000, True)} ELSE {fixed} END AS bucket FROM {name}0
)"""


def price_rows(name: str) -> str:
    mean = price_span("agreement_price", "greatest(2000000, m - 4000000)", "(m + 4000000)", 2_000_000)
    fixed = price_span("agreement_price", "min_price", "max_price", 2_000_000)
    return f"""
{name}0 AS (SELECT *, {PRICE_MEAN} AS m FROM s WHERE agreement_price > 0),
{name} AS (SELECT *, CASE WHEN level = 'project' THEN {mean} ELSE {fixed} END AS bucket FROM {name}0)"""


def age_rows(name: str) -> str:
    return f"""
{name}0 AS (SELECT * EXCLUDE (age), unnest(age) AS years FROM s),
{name} AS (SELECT *, {span("years", "25", "55", 5, True)} AS bucket FROM {name}0)"""


def _area(kind: str, metric: str) -> str:
    value = {
        "count": "CAST(count(*) AS DOUBLE)",
        "carpet": r2("sum(carpet_sqft)"),
        "sales": r2("sum(agreement_price)"),
        "avg_sales": r2("avg(agreement_price)"),
    }[metric]
    return on_s(
        f"SELECT {SK}, bucket, {value} AS value FROM a WHERE kind = '{kind}' AND bucket IS NOT NULL GROUP BY ALL HAVING {value} <> 0",
        area_rows("a", metric in ("sales", "avg_sales")),
    )


SUMS = {
    "unit_sold": "count(*)",
    "total_sales": r2("coalesce(sum(agreement_price), 0)"),
    "ca_consumed_sqft": r2("coalesce(sum(carpet_sqft), 0)"),
}


def _range(rows: str, kind: str, zeros: bool, sales: str = "total_sales") -> str:
    amounts = [SUMS["total_sales"], SUMS["ca_consumed_sqft"]]
    if not zeros:
        amounts = [f"nullif({a}, 0)" for a in amounts]
    return on_s(
        f"SELECT {SK}, bucket, count(*) AS unit_sold, {amounts[0]} AS {sales}, {amounts[1]} AS ca_consumed_sqft "
        f"FROM a WHERE kind = '{kind}' GROUP BY ALL",
        rows,
    )


RATE_OK = "agreement_price > 0 AND net_carpet_area_sqmt > 0"


def _rates(kind: str, column: str, suffix: str) -> str:
    qs = ", ".join(f"{r2(f'quantile_cont({column}, {q})')} AS p{int(q * 100)}_{suffix}" for q in (0.5, 0.75, 0.9))
    return on_s(
        f"SELECT {SK}, {r2(f'avg({column})')} AS wt_avg_{suffix}, {qs} FROM s "
        f"WHERE kind = '{kind}' AND {RATE_OK} AND {column} IS NOT NULL GROUP BY ALL"
    )


def _base(level: str, attributes: dict[str, str]) -> str:
    firsts = "".join(f', arg_min("{src}", document_no) AS "{name}"' for name, src in attributes.items())
    return on_g(
        f"""SELECT {PK}{firsts}, {r2('coalesce(sum(agreement_price), 0)')} AS total_sales,
  {r2('coalesce(sum(carpet_sqft), 0)')} AS total_ca_consumed_sqft_igr, count(document_no) AS total_transactions,
  max(floor_no) AS max_floor, max(transaction_date) AS recent_transaction_date, {TYPE_LABEL} AS project_type
FROM g WHERE level = '{level}' GROUP BY {PK}"""
    )


TYPE_LABEL = (
    "CASE WHEN bool_or(project_type = 'Residential') AND bool_or(project_type = 'Commercial') THEN 'Residential + Commercial' "
    "WHEN bool_or(project_type = 'Residential') THEN 'Residential' WHEN bool_or(project_type = 'Commercial') THEN 'Commercial' "
    "ELSE 'Other' END"
)


def title_sql(x: str) -> str:
    """Title case by splitting after every non-letter."""
    return (
        f"list_aggregate(list_transform(regexp_extract_all(lower({x}), '[a-z]+|[^a-z]'), "
        f"lambda w: upper(w[1]) || w[2:]), 'string_agg', '')"
    )


def _lookup(key: str, key_sql: str, value: str, value_sql: str) -> str:
    return f"""WITH sheet AS (
  SELECT {title_sql(f"trim({key_sql})")} AS k, {title_sql(f"trim({value_sql})")} AS v, p_partkey AS line FROM part
), pairs AS (SELECT k, v, min(line) AS line FROM sheet WHERE k IS NOT NULL GROUP BY k, v)
SELECT k AS "{key}", arg_max(v, line) AS {value} FROM pairs GROUP BY k"""


CITIES = f"SELECT CAST(r_regionkey + 1 AS INTEGER) AS city_id, {star.CITY_NAME.format(r='r_regionkey')} AS city_name FROM region"


def _closest(labels: str, known: list[str], threshold: float) -> str:
    """CTE ``best``: the closest known label of each other label, by the textbook table of common subsequences."""
    values = ", ".join(f"({i}, '{name}')" for i, name in enumerate(known))
    words = lambda c: f"array_to_string(list_sort(list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> '')), ' ')"
    return f"""WITH RECURSIVE names AS ({labels}),
known(position, known) AS (VALUES {values}),
pairs AS (
  SELECT label, position, known, {words('label')} AS a, {words('known')} AS b FROM names, known
  WHERE label NOT IN (SELECT known FROM known)),
steps(label, position, i, line) AS (
  SELECT label, position, 0, list_transform(range(length(b) + 1), lambda j: 0) FROM pairs
  UNION ALL
  SELECT s.label, s.position, s.i + 1, list_prepend(0, list_transform(range(1, length(b) + 1), lambda j: list_max(list_transform(
    range(1, j + 1), lambda k: greatest(s.line[k + 1], CASE WHEN a[s.i + 1] = b[k] THEN s.line[k] + 1 ELSE 0 END)))))
  FROM steps s JOIN pairs p ON s.label = p.label AND s.position = p.position WHERE s.i < length(a)),
scores AS (
  SELECT p.label, p.position, known, CASE WHEN length(a) + length(b) = 0 THEN 100.0 ELSE 200.0 * line[length(b) + 1] / (length(a) + length(b)) END AS score
  FROM pairs p JOIN steps s ON s.label = p.label AND s.position = p.position AND s.i = length(a)),
best AS (
  SELECT label, CASE WHEN score >= {threshold} THEN known ELSE 'Others' END AS match, score
  FROM scores QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, position) = 1)"""


# --- reports ----------------------------------------------------------------------------------


def _long_parts(level: str) -> str:
    """CTE ``l``: every segment metric of a level, one scalar per row."""
    at = f"level = '{level}'"

    def part(metric: str, source: str, value: str, where: str = "true", bucket: str = "NULL", having: str = "true", text: str = "NULL") -> str:
        group = ", bucket" if bucket != "NULL" else ""
        return (
            f"SELECT {SK}, '{metric}' AS metric, CAST({bucket} AS VARCHAR) AS bucket, CAST({value} AS DOUBLE) AS value, CAST({text} AS VARCHAR) AS text "
            f"FROM {source} WHERE {at} AND {where} GROUP BY {SK}{group} HAVING {having}"
        )

    pt = "kind = 'property_type'"
    doc, price, carpet = "count(document_no)", r2("sum(agreement_price)"), r2("sum(carpet_sqft)")
    parts = [
        part("sold_igr", "s", doc, having=f"{doc} <> 0"),
        part("total_agreement_price", "s", price, having=f"{price} <> 0"),
        part("avg_agreement_price", "s", r2("avg(agreement_price)"), "agreement_price > 0"),
        part("ca_consumed_sqft_igr", "s", carpet, having=f"{carpet} <> 0"),
    ]
    rows = "b" if level == "project" else "s"
    mean = r2("avg(carpet_sqft)")
    parts.append(
        part("avg_carpet_area_in_sqft", rows, mean, "kind = 'bhk_br'" + ("" if level == "project" else " AND carpet_sqft > 0"), having=f"{mean} <> 0")
    )
    for column, suffix, kinds in (("rate_on_net_ca", "rate_nca", "true"), ("rate_on_sa", "rate_sa", pt)):
        where = f"{RATE_OK} AND {column} IS NOT NULL AND {kinds}"
        for metric, value in (("wt_avg", f"avg({column})"), *((f"p{q}", f"quantile_cont({column}, {q / 100})") for q in (50, 75, 90))):
            parts.append(part(f"{metric}_{suffix}", "s", r2(value), where, having=f"{r2(value)} <> 0"))
    parts.append(
        f"SELECT {SK}, 'floor_wise_90p_rate', CAST(lo AS VARCHAR) || '-' || CAST(lo + 5 AS VARCHAR), {r2('quantile_cont(rate_on_net_ca, 0.9)')}, NULL "
        f"FROM (SELECT *, CAST(floor(floor_no / 5) * 5 AS INTEGER) AS lo FROM s WHERE floor_no >= 0) WHERE {at} AND {pt} AND {RATE_OK} GROUP BY {SK}, lo"
    )
    q, band = {"project": (0.9, 0.05), "micro": (0.85, 0.07), "pair": (0.85, 0.07)}.get(level, (0.8, 0.1))
    ends = " || '-' || ".join(f"CAST(CAST(trunc(quantile_cont(rate_on_net_ca, {q}) * (1 {sign} {band}::DOUBLE)) AS BIGINT) AS VARCHAR)" for sign in "-+")
    parts.append(part("most_prevailing_rate_range", "s", "NULL", f"{pt} AND {RATE_OK}", text=ends))
    inside = "bucket IS NOT NULL"
    parts += [
        part("total_unit_sold_in_area_range", "ar", "count(*)", inside, "bucket"),
        part("total_ca_consumed_in_area_range_sqft", "ar", carpet, inside, "bucket", f"{carpet} <> 0"),
        part("total_agreement_price_in_area_range", "ap", price, inside, "bucket", f"{price} <> 0"),
        part("avg_agreement_price_in_area_range", "ap", r2("avg(agreement_price)"), inside, "bucket"),
        part("total_unit_sold_in_rate_range", "rr", "count(*)", pt, "bucket"),
    ]
    for source, prefix, sales, zeros in (
        ("pr", "agreement_price_range", "total_sales", True),
        ("rr", "rate_range", "total_sales", False),
        ("ag", "age_range", "total_agreement_price", False),
    ):
        parts.append(part(f"{prefix}_unit_sold", source, "count(*)", bucket="bucket"))
        for metric, value in ((sales, SUMS["total_sales"]), ("ca_consumed_sqft", SUMS["ca_consumed_sqft"])):
            parts.append(part(f"{prefix}_{metric}", source, value, bucket="bucket", having="true" if zeros else f"{value} <> 0"))
    if level != "project":
        for metric, column, where in (("transactions_sale", "property_type_raw", "property_category = 'Sale'"), ("transactions", "property_category", "true")):
            parts.append(
                f"SELECT {PK}, 'label', {column}, '{metric}', NULL, CAST(count(document_no) AS DOUBLE), NULL FROM e "
                f"WHERE {at} AND {where} AND {column} IS NOT NULL GROUP BY {PK}, {column}"
            )
    every = f"""
b AS (SELECT *, 'bhk_br' AS kind, bhk_br AS segment FROM g WHERE bhk_br IS NOT NULL)"""
    ctes = [_grains("sales", "g"), _grains("every", "e"), _segments(), every, area_rows("ar", False), area_rows("ap", True), rate_rows_("rr"), price_rows("pr"), age_rows("ag")]
    return "WITH" + _prepared(level) + ",".join(ctes) + ",\nl AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


# Specification -> (block, step, bounds or none, priced rows only?)
SPECS = {
    "mean_200": ("area", 200, None, False), "mean_350_priced": ("area", 350, None, True), "fixed_150": ("area", 150, (300, 1700), False),
    "price_fixed": ("price", 1500000, (500000, 9000000), False), "price_mean": ("price", 3000000, None, False),
    "rate_fixed": ("rate", 700, (1400, 9000), False), "rate_mean": ("rate", 2500, None, False),
}


def _spec(name: str, levels: str) -> str:
    """A distribution straight from the rows of each segment."""
    block, step, bounds, priced = SPECS[name]
    column, rows = {
        "area": ("carpet_sqft", "net_carpet_area_sqmt > 0 AND carpet_sqft > 0"),
        "price": ("agreement_price", "agreement_price > 0"),
        "rate": ("rate_on_net_ca", f"{RATE_OK} AND rate_on_net_ca > 0"),
    }[block]
    rows += " AND agreement_price > 0" if priced else ""
    unit, reach = (100 if block == "area" else step), (3 if block == "rate" else 2)
    low, high = bounds or (f"(centre - {reach * step})", f"(centre + {reach * step})")
    if block == "price" and not bounds:
        low = f"greatest({step}, {low})"
    last = f"({low} + CAST(ceil(({high} - {low}) / {step}.0) AS BIGINT) * {step})"
    text = lambda x: f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"
    if block == "price":
        money = lambda x: (
            f"CASE WHEN {x} >= 10000000 THEN printf('%.2f Cr', {x} / 10000000.0) WHEN {x} >= 100000 THEN printf('%.2f L', {x} / 100000.0) "
            f"ELSE printf('%.2f K', {x} / 1000.0) END"
        )
        start = f"({low} + greatest(CAST(ceil((v - {low}) / {step}.0) AS BIGINT) - 1, 0) * {step})"
        bucket = f"CASE WHEN v < {low} THEN '< ' || {money(low)} WHEN v > {high} THEN '> ' || {money(high)} ELSE {money(start)} || ' - ' || {money(f'({start} + {step})')} END"
    else:
        start = f"({low} + CAST(floor((v - {low}) / {step}.0) AS BIGINT) * {step})"
        inner = f"{text(start)} || '-' || {text(f'({start} + {step})')}"
        outer = "" if block == "area" and bounds else f"WHEN v < {low} THEN '<' || {text(low)} WHEN v >= {last} THEN '>' || {text(last)}"
        bucket = f"CASE {outer} WHEN v >= {low} AND v < {last} THEN {inner} END"
    return f"""
SELECT '{name}' AS spec, {SK}, {bucket} AS bucket, count(*) AS unit_sold, {r2('coalesce(sum(agreement_price), 0)')} AS total_sales,
  {r2('coalesce(sum(carpet_sqft), 0)')} AS ca_consumed_sqft
FROM (SELECT *, {column} AS v, CAST(round_even(avg({column}) OVER (PARTITION BY {SK}) / {unit}, 0) * {unit} AS BIGINT) AS centre
  FROM s WHERE {rows} AND level IN ({levels}))
GROUP BY {SK}, {bucket} HAVING bucket IS NOT NULL"""


def _number(value: str, kind: str) -> str:
    return f"CAST(CAST({value} AS {'BIGINT' if kind == 'count' else 'DECIMAL(38,2)'}) AS VARCHAR)"


# Labels in the derived transactions.
LABELS = {
    "property_type": ["Apartment", "Flat", "Office", "Others", "Row_House", "Shop"],
    "bhk_br": ["1.5Br", "1Br", "2Br", "3Br", "<1Br", ">3Br", "Office", "Shop"],
    "transactions_sale": ["Flat", "Office", "Others", "Row House", "Shop"],
    "transactions": ["Lease", "Other", "Sale"],
}


def _wide(level: str, grain: str) -> str:
    # No label of the derived table is both a property type and a bedroom label of one metric, so names need no suffix.
    rooms = [m for m in TYPE_METRICS if m not in TYPE_ONLY]
    entries = [("property_type", segment, m) for segment in LABELS["property_type"] for m in TYPE_METRICS]
    for segment in LABELS["bhk_br"]:
        if segment not in NON_BHK_LABELS:
            entries += [("bhk_br", segment, m) for m in rooms]
        if segment not in NON_BHK_LABELS or level == "project":
            entries.append(("bhk_br", segment, "avg_carpet_area_in_sqft"))
    if level != "project":
        entries += [("label", segment, m) for m in ("transactions_sale", "transactions") for segment in LABELS[m]]
    fields, counts = [], set()
    for kind, segment, metric in entries:
        cell = f"max(cell) FILTER (kind = '{kind}' AND segment = '{segment}' AND metric = '{metric}')"
        count = "unit_sold" in metric or metric in ("sold_igr", "transactions_sale", "transactions")
        if "_range" not in metric and not metric.startswith("floor_wise"):
            cell = f"CAST(CAST({cell} AS DOUBLE) AS {'BIGINT' if count else 'DOUBLE'})"
        fields.append(f'{cell} AS "{segment.lower()}_{metric}"')
        if count:
            counts.add(metric)
    number = f"CASE WHEN metric IN ({', '.join(repr(m) for m in sorted(counts))}) THEN {_number('value', 'count')} ELSE {_number('value', 'amount')} END"
    cells = f"""
cells AS (
  SELECT key_id, city, period, kind, segment, metric, coalesce(text, CAST(value AS VARCHAR)) AS cell
  FROM l WHERE grain = '{grain}' AND bucket IS NULL
  UNION ALL
  SELECT key_id, city, period, kind, segment, metric, '{{' || string_agg('"' || bucket || '": ' || {number}, ', ' ORDER BY bucket) || '}}'
  FROM l WHERE grain = '{grain}' AND bucket IS NOT NULL GROUP BY key_id, city, period, kind, segment, metric)"""
    key = {"project": "proj_id", "location": "loc_id", "city": "city_id"}[level]
    period = {"Overall": "", "YoY": ', CAST(k.period AS INTEGER) AS "year"', "QoQ": ", k.period AS quarter"}[grain]
    attributes = {
        "project": {"index": "index", "project": "project_name", "location": "location", "location_id": "location_id", "project_lat": "project_lat", "project_lng": "project_lng", "city_id": "city_id"},
        "location": {"location": "location", "city_id": "city_id", "location_lat": "location_lat", "location_lng": "location_lng"},
        "city": {},
    }[level]
    firsts = "".join(f', arg_min("{src}", document_no) AS "{name}"' for name, src in attributes.items())
    pin = f"'\"' || pincode || '\": [' || n || ', ' || {_number(r2('n / total * 100'), 'amount')} || ', ' || {_number(r2('price'), 'amount')} || ', ' || {_number(r2('price / n'), 'amount')} || ']'"
    deals = f", (SELECT count(*) FROM e WHERE level = '{level}' AND transaction_type = 'Development Agreement' AND e.city = k.city AND e.key_id = k.key_id AND grain = '{grain}' AND e.period = k.period) AS deals"
    extra = "" if level == "project" else ", nullif(k.deals, 0) AS no_of_da_registered"
    skip = "key_id, city, period, " + ("" if level == "project" else "deals, ")
    return f"""{_long_parts(level)},{cells},
base AS (
  SELECT key_id, city, period{firsts}, nullif({r2('coalesce(sum(agreement_price), 0)')}, 0) AS total_sales,
    nullif({r2('coalesce(sum(carpet_sqft), 0)')}, 0) AS total_ca_consumed_sqft_igr, count(document_no) AS total_transactions,
    nullif(max(floor_no), 0) AS max_floor, max(transaction_date) AS recent_transaction_date, {TYPE_LABEL} AS project_type
  FROM g WHERE level = '{level}' AND grain = '{grain}' GROUP BY key_id, city, period),
k AS (SELECT k.*{deals if level != "project" else ""} FROM base k),
m AS (SELECT key_id, city, period, {", ".join(fields)} FROM cells GROUP BY key_id, city, period),
pc AS (
  SELECT key_id, city, period, CAST(CAST(buyer_pincode AS BIGINT) AS VARCHAR) AS pincode, count(*) AS n, sum(agreement_price) AS price,
    any_value(total) AS total
  FROM (SELECT *, count(*) OVER (PARTITION BY key_id, city, period) AS total FROM g WHERE level = '{level}' AND grain = '{grain}' AND agreement_price > 0)
  WHERE buyer_pincode IS NOT NULL GROUP BY key_id, city, period, buyer_pincode),
ps AS (SELECT key_id, city, period, '{{' || string_agg({pin}, ', ' ORDER BY pincode) || '}}' AS pincode_stats FROM pc GROUP BY key_id, city, period)
SELECT '{grain}' AS "Type", '{grain}' AS "Period", k.key_id AS {key}{period}, k.city, k.* EXCLUDE ({skip.rstrip(", ")}){extra},
  m.* EXCLUDE (key_id, city, period), ps.pincode_stats
FROM k LEFT JOIN m ON k.key_id = m.key_id AND k.city = m.city AND k.period = m.period
LEFT JOIN ps ON k.key_id = ps.key_id AND k.city = ps.city AND k.period = ps.period"""


# Metric columns of a property type, in the order in which the wide report has them.
TYPE_METRICS = [
    "sold_igr", "total_agreement_price", "avg_agreement_price", "ca_consumed_sqft_igr", "wt_avg_rate_nca", "p50_rate_nca",
    "p75_rate_nca", "p90_rate_nca", "total_unit_sold_in_area_range", "total_agreement_price_in_area_range",
    "avg_agreement_price_in_area_range", "total_ca_consumed_in_area_range_sqft", "agreement_price_range_unit_sold",
    "agreement_price_range_total_sales", "agreement_price_range_ca_consumed_sqft", "rate_range_unit_sold",
    "rate_range_total_sales", "rate_range_ca_consumed_sqft", "age_range_unit_sold", "age_range_total_agreement_price",
    "age_range_ca_consumed_sqft", "wt_avg_rate_sa", "p50_rate_sa", "p75_rate_sa", "p90_rate_sa", "floor_wise_90p_rate",
    "most_prevailing_rate_range", "total_unit_sold_in_rate_range",
]
# Those of a bedroom label; they stand last, by bedrooms.
TYPE_ONLY = {"wt_avg_rate_sa", "p50_rate_sa", "p75_rate_sa", "p90_rate_sa", "floor_wise_90p_rate", "most_prevailing_rate_range", "total_unit_sold_in_rate_range"}


def _columns() -> str:
    """Columns of the project report over all periods: place, name, filled cells."""
    fixed = [
        ("Type", "count(*)"), ("Period", "count(*)"), ("proj_id", "count(key_id)"), ("city", "count(city)"), *[(c, f'count("{c}")') for c in (
            "index", "project", "location", "location_id", "project_lat", "project_lng", "city_id", "total_sales",
            "total_ca_consumed_sqft_igr", "total_transactions", "max_floor", "recent_transaction_date", "project_type")],
    ]
    heads = " UNION ALL ".join(f"SELECT 1 AS part, '' AS label, {i} AS rank, 0.0 AS rooms, '{n}' AS name, {x} AS filled FROM base" for i, (n, x) in enumerate(fixed))
    types = ", ".join(f"({i}, '{m}')" for i, m in enumerate(TYPE_METRICS))
    rooms = [m for m in TYPE_METRICS if m not in TYPE_ONLY] + ["avg_carpet_area_in_sqft"]
    places = ", ".join(f"({BEDROOM_METRICS.index('_' + m)}, '{m}')" for m in rooms)
    base = _base("project", {"index": "index", "project": "project_name", "location": "location", "location_id": "location_id",
                             "project_lat": "project_lat", "project_lng": "project_lng", "city_id": "city_id"})
    return f"""{_long_parts("project")},
of_type(rank, metric) AS (VALUES {types}), of_rooms(rank, metric) AS (VALUES {places}),
all_rows AS ({base}),
base AS (
  SELECT * REPLACE (nullif(total_sales, 0) AS total_sales, nullif(total_ca_consumed_sqft_igr, 0) AS total_ca_consumed_sqft_igr,
    nullif(total_transactions, 0) AS total_transactions, nullif(max_floor, 0) AS max_floor) FROM all_rows WHERE grain = 'Overall'),
cells AS (
  SELECT kind, segment, metric, count(DISTINCT (city, key_id)) AS filled FROM l WHERE grain = 'Overall' GROUP BY kind, segment, metric),
labels AS (SELECT DISTINCT kind, segment FROM cells),
columns AS (
  {heads}
  UNION ALL
  SELECT 2, n.segment, t.rank, 0, lower(n.segment || '_' || t.metric), coalesce(c.filled, 0)
  FROM labels n CROSS JOIN of_type t LEFT JOIN cells c ON c.kind = n.kind AND c.segment = n.segment AND c.metric = t.metric
  WHERE n.kind = 'property_type'
  UNION ALL
  SELECT 3, segment, 0, 0, lower(segment || '_' || metric), filled FROM cells WHERE kind = 'bhk_br' AND segment IN ({NON_BHK})
  UNION ALL
  SELECT 4, '', 0, 0, 'pincode_stats', count(DISTINCT (city, key_id)) FROM g
  WHERE level = 'project' AND grain = 'Overall' AND agreement_price > 0 AND buyer_pincode IS NOT NULL
  UNION ALL
  SELECT 5, lower(n.segment), t.rank,
    CAST(regexp_extract(n.segment, '[0-9.]+') AS DOUBLE) + CASE n.segment[1] WHEN '<' THEN -0.5 WHEN '>' THEN 0.5 ELSE 0 END,
    lower(n.segment || '_' || t.metric), coalesce(c.filled, 0)
  FROM labels n CROSS JOIN of_rooms t LEFT JOIN cells c ON c.kind = n.kind AND c.segment = n.segment AND c.metric = t.metric
  WHERE n.kind = 'bhk_br' AND n.segment NOT IN ({NON_BHK}))
SELECT CAST(row_number() OVER (ORDER BY part, rooms, label, rank) - 1 AS INTEGER) AS position, name, CAST(filled AS BIGINT) AS filled FROM columns"""


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["city_list"] = CITIES + " ORDER BY city_name"
    out["load_city"] = f"""WITH t AS ({star.transactions_sql()}), c AS ({CITIES})
SELECT t.document_no, c.city_id, c.city_name AS city, t.proj_id, t.property_category, t.agreement_price, t."year"
FROM t JOIN c ON t.city_id = c.city_id WHERE c.city_name IN ('Pune', 'Dubai')"""
    out["bhk_lookup"] = _lookup("BHK", star.RAW_BHK, "standard_label", "concat(' ', CAST(p_size % 6 AS VARCHAR), 'br ')")
    out["prop_lookup"] = _lookup(
        "property_type_raw", star.RAW_TYPE, "property_type_refined",
        "CASE WHEN p_size < 25 THEN lower(p_type) ELSE concat(p_type, '_x') END",
    )
    params = ", ".join(f"{_param(c)} AS {c}" for c in PARAM_COLUMNS)
    out["city_params"] = f"WITH c AS ({CITIES}),{_tables()} SELECT city_id, city_name AS city, {params} FROM c LEFT JOIN city_over o ON c.city_name = o.city"
    out["floor_normalise"] = on_p("SELECT floor_entered AS floor_name_raw, floor_no, count(*) AS n FROM p GROUP BY ALL")
    out["buyer_ages"] = on_p("SELECT age, count(*) AS n FROM (SELECT unnest(age) AS age FROM p) GROUP BY age")
    out["derived_columns"] = on_p(
        "SELECT document_no, agreement_price, buyer_pincode, "
        + ", ".join(f"{r2(c)} AS {c}" for c in ("carpet_sqft", "saleable_sqft", "rate_on_net_ca", "rate_on_sa"))
        + " FROM p"
    )
    out["project_type_fill"] = on_p("SELECT project_type, property_type_raw, count(*) AS n FROM p GROUP BY ALL")
    out["bhk_mapped"] = on_p("SELECT bhk_entered AS raw, bhk_br, count(*) AS n FROM p GROUP BY ALL")
    out["prop_mapped"] = on_p("SELECT type_entered AS raw, property_type_raw, count(*) AS n FROM p GROUP BY ALL")
    out["prop_unmapped"] = (
        f"WITH t AS ({star.transactions_sql(['property_type_raw'])}) SELECT DISTINCT "
        f"{title_sql(chr(34) + 'k' + chr(34))} AS property_type_raw FROM (SELECT coalesce(nullif(lower(trim(property_type_raw)), ''), 'others') AS k FROM t) "
        "WHERE k NOT IN ('flat', 'apartment', 'office', 'others')"
    )
    out["mask_summary"] = on_p(
        f"""SELECT level, count(*) AS base, count(*) FILTER (agreement_price > 0) AS valid_price,
  count(*) FILTER (net_carpet_area_sqmt > 0) AS valid_area, count(*) FILTER ({RATE_OK}) AS valid_rate,
  count(*) FILTER (carpet_sqft > 0) AS valid_carpet,
  count(*) FILTER (bhk_br IS NULL OR bhk_br NOT IN ({NON_BHK})) AS non_bhk FROM sales GROUP BY level"""
    )
    out["price_labels"] = on_p(
        f"SELECT CASE WHEN x IS NOT NULL THEN {money('x')} END AS label, count(*) AS n "
        "FROM (SELECT TRY_CAST(price_entered AS DOUBLE) AS x FROM p) GROUP BY ALL"
    )
    out["project_base"] = _base(
        "project",
        {"index": "index", "project": "project_name", "location": "location", "location_id": "location_id",
         "project_lat": "project_lat", "project_lng": "project_lng", "city_id": "city_id"},
    )
    out["location_base"] = _base(
        "location", {"location": "location", "city_id": "city_id", "location_lat": "location_lat", "location_lng": "location_lng"}
    )
    out["city_base"] = _base("city", {})
    out["project_type_label"] = on_p(f"SELECT level, city, key_id, {TYPE_LABEL} AS project_type FROM sales GROUP BY level, city, key_id")
    totals = (
        f"count(document_no) AS sold_igr, {r2('coalesce(sum(agreement_price), 0)')} AS total_agreement_price, "
        f"{r2('avg(agreement_price) FILTER (agreement_price > 0)')} AS avg_agreement_price, "
        f"{r2('coalesce(sum(carpet_sqft), 0)')} AS ca_consumed_sqft_igr"
    )
    for name, kind in (("pt", "property_type"), ("bhk", "bhk_br")):
        out[f"segment_{name}"] = on_s(f"SELECT {SK}, {totals} FROM s WHERE kind = '{kind}' GROUP BY ALL")
        for metric in ("count", "carpet", "sales", "avg_sales"):
            out[f"area_{name}_{metric}"] = _area(kind, metric)
        out[f"price_{name}"] = _range(price_rows("a"), kind, True)
        out[f"rate_{name}"] = _range(rate_rows_("a"), kind, False)
        out[f"age_{name}"] = _range(age_rows("a"), kind, False, "total_agreement_price")
    carpet = r2("avg(carpet_sqft)")
    out["avg_carpet_bhk"] = on_g(
        f"""SELECT {PK}, 'bhk_br' AS kind, bhk_br AS segment, {carpet} AS avg_carpet_area_in_sqft FROM g
WHERE bhk_br IS NOT NULL AND (level = 'project' OR (bhk_br NOT IN ({NON_BHK}) AND carpet_sqft > 0))
GROUP BY ALL HAVING avg(carpet_sqft) IS NOT NULL"""
    )
    out["txn_sale_by_raw_type"] = on_e(
        f"SELECT {PK}, property_type_raw AS segment, count(document_no) AS n FROM e WHERE property_category = 'Sale' AND property_type_raw IS NOT NULL GROUP BY ALL"
    )
    out["txn_by_category"] = on_e(f"SELECT {PK}, property_category AS segment, count(document_no) AS n FROM e GROUP BY ALL")
    out["da_registered"] = on_e(
        f"""SELECT k.*, d.no_of_da_registered FROM (SELECT DISTINCT {PK} FROM e WHERE property_category = 'Sale') k
LEFT JOIN (SELECT {PK}, count(transaction_type) AS no_of_da_registered FROM e WHERE transaction_type = 'Development Agreement' GROUP BY ALL) d
USING ({PK})"""
    )
    out["rate_nca_pt"] = _rates("property_type", "rate_on_net_ca", "rate_nca")
    out["rate_sa_pt"] = _rates("property_type", "rate_on_sa", "rate_sa")
    out["rate_nca_bhk"] = _rates("bhk_br", "rate_on_net_ca", "rate_nca")
    out["rate_p90_mma"] = on_s(
        f"SELECT {SK}, {r2('quantile_cont(rate_on_net_ca, 0.9)')} AS p90_rate FROM s WHERE kind = 'property_type' AND {RATE_OK} GROUP BY ALL"
    )
    p = "CASE WHEN level = 'project' THEN quantile_cont(rate_on_net_ca, 0.9) ELSE quantile_cont(rate_on_net_ca, 0.8) END"
    b = "CASE WHEN level = 'project' THEN 0.05::DOUBLE ELSE 0.1::DOUBLE END"
    out["prevailing_rate"] = on_s(
        f"""SELECT {SK}, CAST(CAST(trunc(pv * (1 - bv)) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(trunc(pv * (1 + bv)) AS BIGINT) AS VARCHAR)
  AS most_prevailing_rate_range
FROM (SELECT {SK}, {p} AS pv, {b} AS bv FROM s WHERE kind = 'property_type' AND {RATE_OK} GROUP BY {SK})"""
    )
    low = "CAST(floor(floor_no / 5) * 5 AS INTEGER)"
    out["floor_p90_rate"] = on_s(
        f"""SELECT {SK}, CAST({low} AS VARCHAR) || '-' || CAST({low} + 5 AS VARCHAR) AS bucket,
  {r2('quantile_cont(rate_on_net_ca, 0.9)')} AS value
FROM s WHERE kind = 'property_type' AND {RATE_OK} AND floor_no >= 0 GROUP BY ALL"""
    )
    out["rate_count_pt"] = on_s(
        f"SELECT {SK}, bucket, count(*) AS total_unit_sold_in_rate_range FROM a WHERE kind = 'property_type' GROUP BY ALL", rate_rows_("a")
    )
    pins = (
        f"SELECT {PK}, CAST(buyer_pincode AS BIGINT) AS pincode, count(*) AS no_of_transactions, "
        f"{r2('count(*) / any_value(total) * 100')} AS pct_of_total_transactions, {r2('sum(agreement_price)')} AS total_agreement_price, "
        f"{r2('avg(agreement_price)')} AS avg_agreement_price "
        f"FROM (SELECT *, count(*) OVER (PARTITION BY {PK}) AS total FROM g WHERE agreement_price > 0) WHERE buyer_pincode IS NOT NULL GROUP BY {PK}, buyer_pincode"
    )
    out["pincode_stats"] = on_g(pins)
    out["top10_pincodes"] = on_g(
        f"""SELECT *, row_number() OVER (PARTITION BY {PK} ORDER BY count DESC, pincode) AS rank FROM (
  SELECT {PK}, CAST(buyer_pincode AS BIGINT) AS pincode, count(*) AS count FROM g WHERE buyer_pincode IS NOT NULL GROUP BY ALL)
QUALIFY rank <= 10"""
    )
    out["custom_group_fn"] = on_p(
        "SELECT city, key_id, property_type, count(*) AS n, max(agreement_price) - min(agreement_price) AS price_spread "
        "FROM sales WHERE level = 'project' AND agreement_price > 0 GROUP BY ALL"
    )
    for level in ("project", "location", "city"):
        out[f"report_{level}_long"] = f"{_long_parts(level)} SELECT {SK}, metric, bucket, value, text FROM l"
        for grain, suffix in (("Overall", ""), ("YoY", "_yoy"), ("QoQ", "_qoq")):
            out[f"report_{level}{suffix}"] = _wide(level, grain)
    out["report_columns"] = _columns()
    out["report_custom_level"] = f"{_long_parts('micro')} SELECT {SK}, metric, bucket, value, text FROM l"
    for key, levels, names in (("range_specs", "'city', 'project'", list(SPECS)[:3]), ("range_specs_mixed", "'city', 'location'", list(SPECS)[3:])):
        out[key] = "WITH" + _prepared() + _grains("sales", "g") + "," + _segments() + " UNION ALL ".join(_spec(n, levels) for n in names)
    absent = ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in EXPECTED_COLUMNS)
    out["load_audit"] = f"""SELECT count(*) AS rows, count(*) FILTER (floor_no = '7') AS unknown_floors,
  count(*) FILTER (property_type_raw IN ('Row_House', 'Shop')) AS unmapped_types,
  count(*) FILTER (property_category = 'Sale' AND TRY_CAST(agreement_price AS DOUBLE) IS NULL) AS unpriced_sales, {absent}
FROM ({star.transactions_sql()})"""
    out["stacked_loads"] = f"""SELECT document_no, city_id, city, "index", CAST(CASE WHEN city = 'Thane' THEN CAST(net_carpet_area_sqmt AS INTEGER)
  ELSE net_carpet_area_sqmt END AS DOUBLE) AS net_carpet_area_sqmt, TRY_CAST(agreement_price AS DOUBLE) AS agreement_price, CASE WHEN city <> 'Thane' THEN CAST("year" AS BIGINT) END AS "year"
FROM ({star.transactions_sql(['document_no', 'city_id', 'city', 'index', 'net_carpet_area_sqmt', 'agreement_price', 'year'])})
WHERE city IN ('Pune', 'Thane', 'Dubai')"""
    out["whole_group_fn"] = "WITH" + _prepared() + """
ordered AS (
  SELECT city, key_id, property_type, agreement_price AS price, row_number() OVER w AS i, lag(agreement_price) OVER w AS last
  FROM sales WHERE level = 'city' AND agreement_price > 0
  WINDOW w AS (PARTITION BY city, key_id, property_type ORDER BY transaction_date NULLS FIRST, document_no NULLS FIRST, agreement_price)),
runs AS (
  SELECT *, sum(CASE WHEN price > last THEN 0 ELSE 1 END) OVER (PARTITION BY city, key_id, property_type ORDER BY i) AS run FROM ordered),
sizes AS (SELECT city, key_id, property_type, count(*) AS n FROM runs GROUP BY city, key_id, property_type, run)
SELECT city, key_id, property_type, CAST(sum(n) AS BIGINT) AS n, max(n) AS longest_rise FROM sizes GROUP BY city, key_id, property_type"""
    out["report_two_keys"] = (
        f"{_long_parts('pair')} SELECT {SK}, metric, bucket, value, text, location, project_type "
        "FROM l JOIN (SELECT DISTINCT key_id, location, project_type FROM every WHERE level = 'pair') USING (key_id)"
    )
    out["run_all_reports"] = on_g(
        f"""SELECT level, grain AS "Type", key_id, city, CASE WHEN grain = 'YoY' THEN CAST(period AS INTEGER) END AS "year",
  CASE WHEN grain = 'QoQ' THEN period END AS quarter, nullif({r2('coalesce(sum(agreement_price), 0)')}, 0) AS total_sales,
  nullif(count(document_no), 0) AS total_transactions, nullif(max(floor_no), 0) AS max_floor, {TYPE_LABEL} AS project_type
FROM g GROUP BY {PK}"""
    )
    names = "SELECT DISTINCT array_to_string(list_transform(string_split(lower(p_type || ' ' || p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS label FROM part"
    out["fuzzy_labels"] = f"{_closest(names, ['Standard Part', 'Part Small', 'Promo', 'Economy Part 7', 'Large'], 60)} SELECT label, match, {r2('score')} AS score FROM best"
    typed = f"SELECT property_type_raw || 'x' AS label FROM ({star.transactions_sql(['property_type_raw'])}) t"
    known = ["Flat", "Apartment", "Row House", "Shop"]
    out["normalize_labels"] = (
        f"{_closest(f'SELECT DISTINCT label FROM ({typed}) u WHERE label IS NOT NULL', known, 70)} "
        f"SELECT coalesce(match, u.label) AS label, count(*) AS n FROM ({typed}) u LEFT JOIN best ON best.label = u.label GROUP BY 1"
    )
    city = out["city_base"]
    out["report_union"] = f"""WITH b AS ({city})
SELECT grain AS "Type", key_id, total_sales, total_transactions, CASE WHEN grain = 'YoY' THEN period END AS "year",
  CASE WHEN grain = 'QoQ' THEN period END AS quarter FROM b"""
    out["blank_zeros"] = f"WITH b AS ({city}) SELECT {PK}, nullif(total_sales, 0) AS total_sales, nullif(max_floor, 0) AS max_floor FROM b"
    return out
