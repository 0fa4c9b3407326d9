"""DuckDB statements that state the expected result of each registered query.

They read the given tables only. Money is compared as DOUBLE after rounding, other doubles after
rounding to six digits; counts are BIGINT.
"""

from __future__ import annotations

from lakeworks.functions.quality import SENTINELS, STATUS_WORDS
from lakeworks.operators.retrieval import ARTICLE_URL, CONTEXT_K, NO_ABSTRACT, NO_LINK, NO_TITLE, SOURCES_K
from lakeworks.plans import pitches as study
from lakeworks.plans.silver import RULES
from lakeworks.sources.views import VIEWS

MARK = "chr(92) || 'N'"
_SENTINELS = ", ".join("chr(10)" if s == "\n" else f"'{s}'" for s in SENTINELS)
_DATE_FORMATS = ["%m/%d/%Y", "%d/%m/%Y", "%Y-%m-%d", "%m-%d-%Y", "%d-%m-%Y"]


def _missing(column: str, mark: bool) -> str:
    test = f"{column} IS NULL OR lower(trim({column})) IN ({_SENTINELS})"
    return f"({test} OR contains({column}, {MARK}))" if mark else f"({test})"


def _present(column: str, mark: bool) -> str:
    return f"CASE WHEN {_missing(column, mark)} THEN NULL ELSE {column} END AS {column}"


def _iso(column: str) -> str:
    tries = ", ".join(f"try_strptime({column}, '{f}')" for f in _DATE_FORMATS)
    return f"coalesce(strftime(coalesce({tries}), '%Y-%m-%d'), {column}) AS {column}"


def _silver(name: str, table: str | None = None) -> str:
    rule = RULES[name]
    columns = [
        _present(c, rule.checks[c]) if c in rule.checks else _iso(c) if c == rule.date else c for c in rule.columns
    ]
    if rule.checks:
        bad = " OR ".join(_missing(c, mark) for c, mark in rule.checks.items())
        columns.append(f"cast(CASE WHEN {bad} THEN 0 ELSE 1 END AS INTEGER) AS is_valid")
    where = f" WHERE {rule.key} IS NOT NULL" if rule.key else ""
    return f"SELECT {', '.join(columns)} FROM {table or name}_bronze{where}"


_STATUS_ROWS = ", ".join(f"('{raw}', '{std}')" for std, raws in STATUS_WORDS.items() for raw in raws)

_FACT = """
SELECT i.order_id, o.customer_id, i.product_id, o.order_date, o.standard_status AS status, o.country_code AS country,
 o.channel, i.quantity, i.unit_price AS local_price,
 round(i.unit_price * r.exchange_rate_to_usd, 2) AS price_usd,
 round(i.quantity * i.unit_price * r.exchange_rate_to_usd, 2) AS revenue_usd
FROM silver_order_items i
LEFT JOIN silver_orders o ON i.order_id = o.order_id
LEFT JOIN dim_products p ON i.product_id = p.product_id
LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
LEFT JOIN silver_exchange_rates r ON r.currency_code = p.currency
"""

# The rate of the last day with one, up to the order date: each rate is in force until the next day with one.
_IN_FORCE = """
SELECT currency_code, since, lead(since) OVER (PARTITION BY currency_code ORDER BY since) AS until, rate FROM
 (SELECT currency_code, try_strptime(effective_date, '%Y-%m-%d') AS since, max(exchange_rate_to_usd) AS rate FROM silver_rate_history
  WHERE currency_code IS NOT NULL AND try_strptime(effective_date, '%Y-%m-%d') IS NOT NULL GROUP BY 1, 2)
"""
_FACT_AS_OF = """
SELECT l.order_id, l.customer_id, l.product_id, l.order_date, l.status, l.country, l.channel, cast(l.quantity AS DOUBLE) AS quantity,
 cast(l.unit_price AS DOUBLE) AS local_price, cast(round(l.unit_price * r.rate, 2) AS DOUBLE) AS price_usd,
 cast(round(l.quantity * l.unit_price * r.rate, 2) AS DOUBLE) AS revenue_usd
FROM (SELECT i.order_id, o.customer_id, i.product_id, o.order_date, o.standard_status AS status, o.country_code AS country,
  o.channel, i.quantity, i.unit_price, p.currency, try_strptime(o.order_date, '%Y-%m-%d') AS d FROM silver_order_items i
 LEFT JOIN silver_orders o ON i.order_id = o.order_id
 LEFT JOIN dim_products p ON i.product_id = p.product_id
 LEFT JOIN dim_customers c ON o.customer_id = c.customer_id) l
LEFT JOIN in_force r ON r.currency_code = l.currency AND r.since <= l.d AND (r.until IS NULL OR r.until > l.d)
"""

_CONTEXT_CHUNKS = """
SELECT question_id, rank, doc_id, 600 * i AS start, 600 * i + length(substring(text, 600 * i + 1, 700)) AS "end", substring(text, 600 * i + 1, 700) AS chunk_text
FROM (SELECT *, CASE WHEN place < 700 THEN 0 ELSE (place - 700) // 600 + 1 END AS i FROM context_hits JOIN vector_places USING (vec_id) JOIN documents USING (doc_id))
WHERE length(text) > 0
"""

_CHUNK_SOURCES = """
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE 'Topic ' || cast(label AS string) END AS title,
 CASE WHEN vec_id % 11 = 0 THEN NULL ELSE 'https://example.org/' || cast(label AS string) || '/' || cast(vec_id % 2 AS string) END AS source
FROM embeddings
"""

# Shared views over the given tables, used by Spark as well.
ARTICLES = """
SELECT doc_id AS pmid, source || ' ' || lang || ' ' || cast(doc_id AS string) AS title,
 CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS body
FROM documents
"""
CHUNK_SOURCES = _CHUNK_SOURCES

_QUESTIONS = """
SELECT label AS question_id, list(x ORDER BY i) AS question_vector FROM
 (SELECT label, i, avg(x) AS x FROM
   (SELECT label, unnest(cast(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
  GROUP BY label, i) GROUP BY label
"""


def _hits(k: int) -> str:
    return f"""
SELECT * FROM (SELECT question_id, vec_id, distance, cast(row_number() OVER (PARTITION BY question_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM
 (SELECT question_id, vec_id, list_distance(cast(embedding AS DOUBLE[]), question_vector) ** 2 AS distance FROM embeddings, questions)) WHERE rank <= {k}
"""


def _series(columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, deal, cast({c} AS DOUBLE) AS x FROM features" for c in columns)


_CLEAN = """
SELECT pitch_id, cast(deal AS INTEGER) AS deal, category, askedfor, exchangeforstake, valuation, season,
 cast(multiple_entreprenuers AS INTEGER) AS multiple_entreprenuers, has_website, shark1, shark2, shark3, shark4, shark5
FROM pitches WHERE askedfor IS NOT NULL AND exchangeforstake IS NOT NULL AND valuation IS NOT NULL
"""

_SECOND_CLEAN = _CLEAN.replace(" AND exchangeforstake IS NOT NULL", "")

_FEATURES = """
SELECT *, askedfor / valuation AS investment_ratio, valuation / askedfor AS valuation_ask_ratio,
 ln(1 + askedfor) AS log_askedfor, ln(1 + valuation) AS log_valuation,
 CASE WHEN season <= 2 THEN 'Early (S1-S2)' WHEN season <= 4 THEN 'Mid (S3-S4)' ELSE 'Late (S5-S6)' END AS season_group,
 concat_ws(',', shark1, shark2, shark3, shark4, shark5) AS all_sharks
FROM {clean}
"""

_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    **{name: (text, ()) for name, text in VIEWS.items()},
    **{f"silver_{name}": (_silver(name), (f"{name}_bronze",)) for name in RULES if name != "orders"},
    "orders_cleaned": (_silver("orders"), ("orders_bronze",)),
    "status_map": (f"SELECT * FROM (VALUES {_STATUS_ROWS}) AS t(raw_status, standard_status)", ()),
    "silver_orders": (
        f"""SELECT order_id, customer_id, order_date, {_present('order_status', False)}, country_code, channel, total_amount,
 currency, is_valid, standard_status, cast({_missing('order_status', False)} AS INTEGER) AS is_invalid_status
 FROM orders_cleaned LEFT JOIN status_map ON order_status = raw_status""",
        ("orders_cleaned", "status_map"),
    ),
    "dim_customers": (
        "SELECT DISTINCT customer_id, customer_name, email, country_code FROM silver_customers",
        ("silver_customers",),
    ),
    "dim_products": (
        "SELECT DISTINCT product_id, product_name, category, price, country_code, currency FROM silver_products",
        ("silver_products",),
    ),
    "fact_orders": (
        _FACT,
        ("silver_order_items", "silver_orders", "dim_products", "dim_customers", "silver_exchange_rates"),
    ),
    "silver_rate_history": (_silver("exchange_rates", "rate_history"), ("rate_history_bronze",)),
    "in_force": (_IN_FORCE, ("silver_rate_history",)),
    "pitch_clean": (_CLEAN, ("pitches",)),
    "features": (_FEATURES.format(clean="pitch_clean"), ("pitch_clean",)),
    "second_clean": (_SECOND_CLEAN, ("pitches",)),
    "second_features": (_FEATURES.format(clean="second_clean"), ("second_clean",)),
    "articles": (ARTICLES, ()),
    "chunk_sources": (CHUNK_SOURCES, ()),
    "questions": (_QUESTIONS, ()),
    "hits": (_hits(SOURCES_K), ("questions",)),
    "context_hits": (_hits(CONTEXT_K), ("questions",)),
}


def _ordered(needs: tuple[str, ...], done: list[str]) -> list[str]:
    for name in needs:
        if name not in done:
            _ordered(_PARTS[name][1], done)
            done.append(name)
    return done


def _sql(body: str, *needs: str) -> str:
    parts = [f"{name} AS ({_PARTS[name][0].strip()})" for name in _ordered(needs, [])]
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()


def _money(*columns: str) -> str:
    return ", ".join(f"cast({c} AS DOUBLE) AS {c}" for c in columns)


def _six(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_DONE = "CASE WHEN status = 'completed' THEN revenue_usd END"
_DONE_SUM = f"cast(round(sum({_DONE}), 2) AS DOUBLE)"

# Mean in whole cents: half up to six digits, then half up to two, in integers throughout.
_CENTS = "cast(sum(revenue_usd) * 100 AS HUGEINT)"
_LINES = "cast(count(revenue_usd) AS HUGEINT)"
_AVERAGE = f"""cast(CASE WHEN count(revenue_usd) = 0 THEN NULL ELSE
 (((2 * {_CENTS} * 10000 + {_LINES}) // (2 * {_LINES})) + 5000) // 10000 END AS DOUBLE) / 100.0"""

_CUBE = f"""
SELECT {{dims}}, cast(round(sum(revenue_usd), 2) AS DOUBLE) AS total_revenue_usd, count(DISTINCT order_id) AS total_orders,
 {_AVERAGE} AS avg_order_value{{extra}}
FROM (SELECT *, cast(year(d) AS string) AS year, cast(month(d) AS string) AS month FROM
 (SELECT *, try_cast(order_date AS DATE) AS d FROM fact_orders))
GROUP BY CUBE (year, month, country, channel, product_id)
"""
_CUBE_DIMS = ", ".join(f"coalesce({c}, 'ALL') AS {c}" for c in ("year", "month", "country", "channel", "product_id"))


def _aov() -> str:
    orders = f"SELECT order_id, round(sum({_DONE}), 2) AS r FROM fact_orders GROUP BY order_id"
    cents = "cast(sum(r) * 100 AS HUGEINT)"
    lines = "cast(count(r) AS HUGEINT)"
    mean = f"(((2 * {cents} * 10000 + {lines}) // (2 * {lines})) + 5000) // 10000"
    return f"SELECT cast({mean} AS DOUBLE) / 100.0 AS \"AOV\" FROM ({orders})"


def _content(name: str) -> str:
    """Row count and an order-free content sum of one ingested table."""
    columns = ", ".join(f"coalesce(cast({c} AS string), '~')" for c in RULES[name].columns)
    return f"""SELECT '{name}_bronze' AS table_name, count(*) AS n_rows,
 cast(sum(cast('0x' || substr(md5(concat_ws('|', {columns})), 1, 8) AS BIGINT)) AS BIGINT) AS content_sum FROM {name}_bronze"""


def _ttest(feature: str) -> str:
    side = {1: "yes", 0: "no"}
    means = ", ".join(
        f"avg({feature}) FILTER (deal = {v}) AS mean_{s}, stddev_samp({feature}) FILTER (deal = {v}) AS std_{s}, count(*) FILTER (deal = {v}) AS n_{s}"
        for v, s in side.items()
    )
    return f"SELECT '{feature}' AS feature, {means} FROM features"


_TTESTS = f"""
SELECT feature, {_six('mean_yes', 'mean_no', 't_statistic')}, n_yes, n_no, abs(t_statistic) > 2 AS significant FROM
 (SELECT *, (mean_yes - mean_no) / sqrt(std_yes ** 2 / n_yes + std_no ** 2 / n_no) AS t_statistic
  FROM ({' UNION ALL '.join(_ttest(f) for f in study.TESTED)}))
"""

_COMPARED = " UNION ALL ".join(
    f"SELECT '{f}' AS factor, avg(deal) FILTER ({f} = 0) * 100 AS rate_off, avg(deal) FILTER ({f} = 1) * 100 AS rate_on FROM features"
    for f in ("multiple_entreprenuers", "has_website")
)
_COMPARISONS = f"""
SELECT factor, {_six('rate_off', 'rate_on')}, round(abs(rate_on - rate_off), 6) AS difference, abs(rate_on - rate_off) > 5 AS meaningful
FROM ({_COMPARED})
"""


def _rates(key: str, rows: str = "features") -> str:
    return f"SELECT {key}, avg(deal) AS deal_rate, count(deal) AS total_pitches, round(avg(deal) * 100, 2) AS deal_rate_pct FROM {rows} WHERE {key} IS NOT NULL GROUP BY {key}"


def _range(key: str, verdict: str) -> str:
    return f"SELECT '{key}' AS grouping, max(deal_rate_pct) AS max_rate, min(deal_rate_pct) AS min_rate, round(max(deal_rate_pct) - min(deal_rate_pct), 2) AS rate_range, {verdict} AS significant FROM ({_rates(key)})"


_RANGES = f"{_range('category', 'true')} UNION ALL {_range('season', 'max(deal_rate_pct) - min(deal_rate_pct) > 10')}"

_SUBJECTS = dict(
    zip(
        ["exchangeforstake", "valuation_ask_ratio", "category", "multiple_entreprenuers", "has_website", "askedfor", "season"],
        study.HYPOTHESES,
    )
)
_HYPOTHESIS_ROWS = ", ".join(f"('{s}', '{n}', '{t}', '{m}')" for s, (n, t, m) in _SUBJECTS.items())
_HYPOTHESES = f"""
SELECT no, hypothesis, test_used, round(measure, 6) AS measure,
 CASE WHEN verdict THEN 'difference found' ELSE 'no clear difference' END AS result
FROM (SELECT feature AS subject, t_statistic AS measure, significant AS verdict FROM ({_TTESTS})
 UNION ALL SELECT factor, difference, meaningful FROM ({_COMPARISONS})
 UNION ALL SELECT grouping, rate_range, significant FROM ({_RANGES}))
JOIN (VALUES {_HYPOTHESIS_ROWS}) AS h(subject, no, hypothesis, test_used) USING (subject)
"""

_CORRELATED = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(corr({f}, deal), 4) AS correlation FROM features" for f in study.CORRELATED
)

OLS_FEATURES = ["exchangeforstake", "valuation_ask_ratio", "season"]
OLS_TARGET = "askedfor"

_TRAIN = "SELECT *, row_number() OVER (ORDER BY pitch_id) <= floor(cast(0.7 AS DOUBLE) * count(*) OVER ()) AS is_train FROM features"
_OLS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, regr_slope({OLS_TARGET}, {f}) AS slope, regr_intercept({OLS_TARGET}, {f}) AS intercept, avg({f}) AS x_mean FROM split WHERE is_train"
    for f in OLS_FEATURES
)
_OLS_MODEL = ", ".join(
    f"regr_slope({OLS_TARGET}, {f}) FILTER (is_train) AS s{i}, avg({f}) FILTER (is_train) AS m{i}" for i, f in enumerate(OLS_FEATURES)
)
_OLS_PREDICT = f"""
SELECT pitch_id, round(b - {' - '.join(f's{i} * m{i}' for i in range(3))} + {' + '.join(f's{i} * {f}' for i, f in enumerate(OLS_FEATURES))}, 4) AS prediction,
 {OLS_TARGET} AS actual
FROM split, (SELECT avg({OLS_TARGET}) AS b, {_OLS_MODEL} FROM split) WHERE NOT is_train
"""


def _split(body: str) -> str:
    return _sql(f"SELECT * FROM (WITH split AS ({_TRAIN}) {body})", "features")


def _edge(bin_no: str) -> str:
    return f"CASE WHEN {bin_no} >= 20 THEN hi ELSE lo + ({bin_no}) * ((hi - lo) / 20) END"


def _histogram(series: str, keys: str) -> str:
    return f"""
SELECT {keys}, cast(g.bin + 1 AS INTEGER) AS bin, round({_edge('g.bin')}, 6) AS lower_edge, round({_edge('g.bin + 1')}, 6) AS upper_edge,
 coalesce(n, 0) AS n_rows
FROM (SELECT * FROM (SELECT {keys}, min(x) AS lo, max(x) AS hi FROM ({series}) WHERE x IS NOT NULL GROUP BY {keys}), (SELECT unnest(range(20)) AS bin)) g
LEFT JOIN (SELECT {keys}, guess - cast(x < {_edge('guess')} AS BIGINT) + cast(guess < 19 AND x >= {_edge('guess + 1')} AS BIGINT) AS bin, count(*) AS n
 FROM (SELECT *, least(cast(floor((x - lo) / (hi - lo) * 20) AS BIGINT), 19) AS guess FROM ({series})
  JOIN (SELECT {keys}, min(x) AS lo, max(x) AS hi FROM ({series}) GROUP BY {keys}) USING ({keys}) WHERE x IS NOT NULL) GROUP BY ALL)
USING ({keys}, bin)
"""


def _fences(series: str, keys: str) -> str:
    cuts = ", ".join(f"quantile_cont(x, {p}) AS {name}" for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))
    return f"""SELECT * FROM ({series}) JOIN (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM
 (SELECT {keys}, {cuts} FROM ({series}) GROUP BY {keys})) USING ({keys}) WHERE x IS NOT NULL"""


def _box(series: str, keys: str) -> str:
    inside = "x BETWEEN low AND high"
    return f"""
SELECT {keys}, {_six('q1', 'median', 'q3', 'whisker_low', 'whisker_high')}, n_outliers FROM
 (SELECT {keys}, q1, median, q3, min(x) FILTER ({inside}) AS whisker_low, max(x) FILTER ({inside}) AS whisker_high,
  count(*) FILTER (NOT ({inside})) AS n_outliers FROM ({_fences(series, keys)}) GROUP BY {keys}, q1, median, q3)
"""


_RATIO = "SELECT 'investment_ratio' AS feature, investment_ratio AS x FROM second_features"


def _describe() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 4) AS std, cast(min({c}) AS DOUBLE) AS min,
 round(quantile_cont(cast({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(cast({c} AS DOUBLE), 0.5), 6) AS q50,
 round(quantile_cont(cast({c} AS DOUBLE), 0.75), 6) AS q75, cast(max({c}) AS DOUBLE) AS max FROM pitches"""
        for c in study.NUMERIC
    )


def _gaps(columns: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, count(*) AS n FROM pitches" for c in columns
    )
    return f"SELECT column_name, missing_count, round(missing_count * 100 / n, 2) AS missing_pct FROM ({rows}) WHERE missing_count > 0"


PITCH_COLUMNS = [
    "pitch_id", "deal", "description", "category", "askedfor", "exchangeforstake", "valuation", "season",
    "multiple_entreprenuers", "has_website", *study.SHARKS,
]

def _csv_rejects() -> str:
    """Rows that fit, as read back; records with words for a number; records cut off after eight columns."""
    whole, money = ("pitch_id", "season", "has_website"), ("askedfor", "exchangeforstake", "valuation")
    plain = {c: f"cast({c} AS decimal(18,2))" if c in money else c for c in PITCH_COLUMNS}
    plain["description"] = "replace(description, chr(34), chr(39))"
    read = {c: f"cast({x} AS BIGINT)" if c in whole else f"cast({x} AS DOUBLE)" if c in money else x for c, x in plain.items()}
    cells = [f"coalesce(chr(34) || cast({x} AS string) || chr(34), '')" for x in plain.values()]
    words = ["chr(34) || 'on request' || chr(34)" if c == "askedfor" else x for c, x in zip(PITCH_COLUMNS, cells)]
    cut, word = "pitch_id % 17 = 0", "pitch_id % 13 = 0"
    nothing = ", ".join(f"NULL AS {c}" for c in PITCH_COLUMNS)
    records = [
        (words, f"{word} AND NOT {cut}", "askedfor: on request is no double"),
        (cells[:8], f"{cut} AND NOT {word}", f"not {len(PITCH_COLUMNS)} fields"),
        (words[:8], f"{cut} AND {word}", f"not {len(PITCH_COLUMNS)} fields"),
    ]
    fits = ", ".join(f"{x} AS {c}" for c, x in read.items())
    parts = [f"SELECT {fits}, NULL AS record, NULL AS reason FROM pitches WHERE NOT {cut} AND NOT {word}"]
    for fields, where, reason in records:
        line = " || ',' || ".join(fields)
        parts.append(f"SELECT {nothing}, {line} AS record, '{reason}' AS reason FROM pitches WHERE {where}")
    return " UNION ALL ".join(parts)


_SILVER_MONEY = {
    "customers": (),
    "orders": ("total_amount",),
    "order_items": ("quantity", "unit_price", "line_total"),
    "products": ("price",),
    "exchange_rates": ("exchange_rate_to_usd",),
}


def _replace(columns: tuple[str, ...]) -> str:
    return f"* REPLACE ({_money(*columns)})" if columns else "*"


_WIDTHS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}


# The overwrite lacks the email, which moves the later columns up, reads the number as a number and brings a score.
_REFUSED = """
SELECT column_name, old_type, new_type, verdict, (SELECT count(*) FROM silver_customers) AS n_rows FROM (VALUES
 ('customer_id', 'string', 'bigint', 'retyped'), ('customer_name', 'string', 'string', 'same'), ('email', 'string', NULL, 'dropped'),
 ('registration_date', 'string', 'string', 'moved'), ('country_code', 'string', 'string', 'moved'), ('channel', 'string', 'string', 'moved'),
 ('is_valid', 'int', 'int', 'moved'), ('score', NULL, 'int', 'added')) AS t(column_name, old_type, new_type, verdict)
"""


def _types(name: str) -> str:
    """Columns of a table, with the names Spark has for DuckDB's types."""
    words = {"VARCHAR": "string", "INTEGER": "int", "FLOAT[]": "array<float>", "DOUBLE[]": "array<double>"}
    cases = " ".join(f"WHEN '{duck}' THEN '{spark}'" for duck, spark in words.items())
    return f"""SELECT '{name}' AS table_name, cast(row_number() OVER () AS INTEGER) AS position, column_name,
 CASE WHEN column_type LIKE 'TIMESTAMP%' THEN CASE WHEN column_type LIKE '%ZONE' THEN 'timestamp' ELSE 'timestamp_ntz' END
  ELSE CASE column_type {cases} ELSE lower(column_type) END END AS column_type FROM (DESCRIBE SELECT * FROM {name})"""


def statements() -> dict[str, str]:
    out = {
        "table_shape": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, {n} AS n_columns FROM {t}" for t, n in _WIDTHS.items()
        ),
        "bronze_ingest": _sql(
            " UNION ALL ".join(_content(name) for name in RULES), *[f"{name}_bronze" for name in RULES]
        ),
        "source_lineage": "SELECT 'lineitem.parquet' AS source_file_name, true AS stamped, count(*) AS n_rows FROM lineitem",
        "column_types": " UNION ALL ".join(_types(t) for t in _WIDTHS),
        "preview_orders": _sql(
            f"SELECT {_replace(('total_amount',))} FROM silver_orders ORDER BY order_id NULLS FIRST, customer_id NULLS FIRST LIMIT 5", "silver_orders"
        ),
        "schema_checked_overwrite": _sql("SELECT * FROM silver_customers WHERE is_valid = 1", "silver_customers"),
        "schema_refused_overwrite": _sql(_REFUSED, "silver_customers"),
    }
    for name in RULES:
        out[f"silver_{name}"] = _sql(f"SELECT {_replace(_SILVER_MONEY[name])} FROM silver_{name}", f"silver_{name}")
    flagged = [name for name in RULES if RULES[name].checks]
    out["validity_summary"] = _sql(
        " UNION ALL ".join(f"SELECT '{n}' AS table_name, is_valid, count(*) AS n_rows FROM silver_{n} GROUP BY is_valid" for n in flagged),
        *[f"silver_{n}" for n in flagged],
    )
    out["missing_profile"] = _sql(_gaps(PITCH_COLUMNS), "pitches")
    out["dim_customers"] = _sql("SELECT * FROM dim_customers", "dim_customers")
    out["dim_products"] = _sql(f"SELECT {_replace(('price',))} FROM dim_products", "dim_products")
    out["dim_date"] = _sql(
        """SELECT DISTINCT cast(d AS DATE) AS date, cast(year(d) AS INTEGER) AS year, cast(month(d) AS INTEGER) AS month, cast(day(d) AS INTEGER) AS day
 FROM (SELECT try_strptime(order_date, '%Y-%m-%d') AS d FROM silver_orders)""",
        "silver_orders",
    )
    out["fact_orders"] = _sql(
        f"SELECT {_replace(('quantity', 'local_price', 'price_usd', 'revenue_usd'))} FROM fact_orders", "fact_orders"
    )
    out["fact_orders_as_of"] = _sql(
        _FACT_AS_OF, "silver_order_items", "silver_orders", "dim_products", "dim_customers", "in_force"
    )
    out["cube_sales"] = _sql(_CUBE.format(dims=_CUBE_DIMS, extra=""), "fact_orders")
    out["cube_sales_grouping_id"] = _sql(
        _CUBE.format(
            dims=_CUBE_DIMS, extra=", cast(grouping_id(year, month, country, channel, product_id) AS BIGINT) AS grouping_id"
        ),
        "fact_orders",
    )
    kpis = {
        "kpi_total_revenue": f"SELECT {_DONE_SUM} AS total_revenue_usd FROM fact_orders",
        "kpi_revenue_country": f"SELECT country, {_DONE_SUM} AS total_revenue_usd FROM fact_orders GROUP BY country",
        "kpi_revenue_channel": f"SELECT channel, {_DONE_SUM} AS revenue FROM fact_orders GROUP BY channel",
        "kpi_completed_orders": "SELECT count(DISTINCT order_id) AS completed_orders FROM fact_orders WHERE status = 'completed'",
        "kpi_completed_order_rate": """SELECT round(count(DISTINCT CASE WHEN status = 'completed' THEN order_id END) / count(DISTINCT order_id), 6) AS completed_order_rate
 FROM fact_orders""",
        "kpi_aov": _aov(),
        "kpi_top_products": f"SELECT product_id, {_DONE_SUM} AS revenue_usd FROM fact_orders GROUP BY product_id ORDER BY revenue_usd DESC NULLS LAST, product_id LIMIT 5",
        "kpi_active_customers": "SELECT count(DISTINCT customer_id) AS active_customers FROM fact_orders",
        "kpi_customer_acquisition": """SELECT strftime(try_strptime(first_order_date, '%Y-%m-%d'), '%Y-%m') AS year_month, count(DISTINCT customer_id) AS new_customers
 FROM (SELECT customer_id, min(order_date) AS first_order_date FROM fact_orders GROUP BY customer_id) GROUP BY 1""",
        "kpi_data_quality": """SELECT round(sum(CASE WHEN order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND status IS NOT NULL THEN 1 ELSE 0 END) / count(*), 6) AS data_quality_score
 FROM fact_orders""",
    }
    kpis["kpi_scorecard"] = f"""SELECT * FROM ({kpis['kpi_total_revenue']}), ({kpis['kpi_completed_orders']}),
 ({kpis['kpi_completed_order_rate']}), ({kpis['kpi_aov']})"""
    out.update({name: _sql(body, "fact_orders") for name, body in kpis.items()})

    out["pitch_clean"] = _sql("SELECT * FROM pitch_clean", "pitch_clean")
    out["pitch_features"] = _sql(
        f"SELECT * REPLACE ({_six('investment_ratio', 'valuation_ask_ratio', 'log_askedfor', 'log_valuation')}) FROM features",
        "features",
    )
    listed = ", ".join(PITCH_COLUMNS)
    out["pitch_dropna_all"] = _sql(
        f"SELECT {listed} FROM pitches WHERE {' AND '.join(f'{c} IS NOT NULL' for c in PITCH_COLUMNS)}", "pitches"
    )
    out["pitch_csv_roundtrip"] = _sql(f"SELECT {listed} FROM pitches", "pitches")
    out["csv_rejects"] = _sql(_csv_rejects(), "pitches")
    out["describe_numeric"] = _sql(_describe(), "pitches")
    out["value_counts_deal"] = _sql(
        "SELECT deal, count(*) AS n_rows, round(count(*) * 100 / (SELECT count(deal) FROM pitch_clean), 2) AS share_pct FROM pitch_clean GROUP BY deal",
        "pitch_clean",
    )
    out["overall_rate"] = _sql(
        """SELECT count(*) AS total, cast(sum(deal) AS BIGINT) AS deals, cast(count(*) - sum(deal) AS BIGINT) AS no_deals,
 round(sum(deal) * 100 / count(*), 2) AS success_pct, printf('%.2f%%', round(sum(deal) * 100 / count(*), 2)) AS success_text
 FROM (SELECT cast(deal AS INTEGER) AS deal FROM pitches)""",
        "pitches",
    )
    out["value_counts_raw"] = _sql(
        "SELECT deal, count(*) AS n_rows, round(count(*) * 100 / (SELECT count(deal) FROM pitches), 2) AS share_pct FROM pitches GROUP BY deal",
        "pitches",
    )
    out["rate_by_category"] = _sql(f"SELECT category, {_six('deal_rate')}, total_pitches, deal_rate_pct FROM ({_rates('category')})", "features")
    out["top_categories"] = _sql(
        f"SELECT category, {_six('deal_rate')} FROM (SELECT * FROM ({_rates('category', 'second_features')}) ORDER BY deal_rate DESC, category LIMIT 5)",
        "second_features",
    )
    out["rate_by_season"] = _sql(f"SELECT season, deal_rate_pct, total_pitches FROM ({_rates('season')})", "features")
    out["season_extremes"] = _sql(
        f"""SELECT * FROM (WITH r AS ({_rates('season')}) SELECT max(deal_rate_pct) AS max_rate,
 (SELECT season FROM r ORDER BY deal_rate_pct DESC, season LIMIT 1) AS max_key, min(deal_rate_pct) AS min_rate,
 (SELECT season FROM r ORDER BY deal_rate_pct, season LIMIT 1) AS min_key,
 round(max(deal_rate_pct) - min(deal_rate_pct), 2) AS rate_range FROM r)""",
        "features",
    )
    out["rate_by_investor"] = _sql(
        " UNION ALL ".join(
            f"SELECT '{n}' AS investor, round(avg(deal), 6) AS success_rate FROM second_features WHERE contains(lower(all_sharks), '{n.lower()}')"
            for n in study.INVESTORS
        ),
        "second_features",
    )
    out["rate_comparison"] = _sql(_COMPARISONS, "features")
    out["ttest_by_outcome"] = _sql(_TTESTS, "features")
    out["group_range_test"] = _sql(_RANGES, "features")
    out["ratio_by_outcome"] = _sql(
        "SELECT round(avg(investment_ratio) FILTER (deal = 1), 6) AS success_ratio, round(avg(investment_ratio) FILTER (deal = 0), 6) AS failure_ratio FROM second_features",
        "second_features",
    )
    out["hypothesis_summary"] = _sql(_HYPOTHESES, "features")
    out["feature_correlation"] = _sql(
        f"SELECT feature, correlation, CASE WHEN correlation >= 0 THEN 'positive' ELSE 'negative' END AS direction FROM ({_CORRELATED})",
        "features",
    )
    out["train_test_split"] = _split("SELECT pitch_id, is_train FROM split")
    # A scan in file order numbers its rows as they stand.
    out["split_by_position"] = """SELECT is_train, count(*) AS n_rows, cast(sum(l_orderkey) AS BIGINT) AS key_sum, cast(max(l_orderkey) AS BIGINT) AS last_key FROM
 (SELECT l_orderkey, row_number() OVER () <= floor(cast(0.7 AS DOUBLE) * (SELECT count(*) FROM lineitem)) AS is_train FROM lineitem) GROUP BY is_train"""
    out["ols_per_feature"] = _split(f"SELECT feature, {_six('slope', 'intercept', 'x_mean').replace('6)', '4)')} FROM ({_OLS})")
    out["ols_predict"] = _split(_OLS_PREDICT)
    out["histogram_by_outcome"] = _sql(_histogram(_series(["exchangeforstake", "investment_ratio"]), "feature, deal"), "features")
    out["histogram_ratio"] = _sql(_histogram(_RATIO, "feature"), "second_features")
    out["boxplot_by_outcome"] = _sql(_box(_series(study.BOXED), "feature, deal"), "features")
    out["boxplot_ratio"] = _sql(_box(_RATIO, "feature"), "second_features")
    out["boxplot_outliers"] = _sql(
        f"SELECT feature, deal, round(x, 6) AS x FROM ({_fences(_series(study.BOXED), 'feature, deal')}) WHERE NOT x BETWEEN low AND high",
        "features",
    )
    out["above_average_groups"] = _sql(
        f"""SELECT category, round(deal_rate * 100, 6) AS rate_pct,
 CASE WHEN deal_rate * 100 >= (SELECT avg(deal) * 100 FROM features) THEN 'Above Average' ELSE 'Below Average' END AS class FROM ({_rates('category')})""",
        "features",
    )
    out["scatter_points"] = _sql("SELECT valuation, deal FROM second_features", "second_features")
    out["article_documents"] = _sql(
        f"""SELECT pmid, coalesce(replace(body, chr(10), ' '), '{NO_ABSTRACT}') AS page_content, title,
 '{ARTICLE_URL.replace('%s', "' || cast(pmid AS string) || '")}' AS source FROM articles""",
        "articles",
    )
    out["chunk_fixed"] = """
SELECT doc_id, cast(i AS INTEGER) AS chunk_no, substring(text, cast(600 * i + 1 AS BIGINT), 700) AS chunk_text
FROM (SELECT doc_id, text, unnest(range(greatest(1, cast(ceil((length(text) - 100) / 600.0) AS BIGINT)))) AS i FROM documents WHERE length(text) > 0)
"""
    out["chunk_recursive_law"] = """
SELECT doc_id, true AS within_size, true AS holds_its_text, true AS within_overlap, true AS in_order, true AS whole
FROM documents WHERE regexp_matches(text, '[^[:space:]]')
"""
    out["topk_vectors"] = _sql(f"SELECT question_id, vec_id, {_six('distance')}, rank FROM hits", "hits")
    out["topk_one_question"] = """
SELECT vec_id, round(list_distance(cast(embedding AS DOUBLE[]), question) ** 2, 6) AS distance FROM embeddings,
 (SELECT list(x ORDER BY i) AS question FROM (SELECT i, avg(x) AS x FROM
  (SELECT unnest(cast(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i))
ORDER BY list_distance(cast(embedding AS DOUBLE[]), question), vec_id LIMIT 3
"""
    out["context_chunks"] = _sql(_CONTEXT_CHUNKS, "context_hits", "vector_places")
    out["context_per_query"] = _sql(
        f"""SELECT question_id, coalesce(string_agg(chunk_text, chr(10) || chr(10) ORDER BY rank), '') AS context
 FROM (SELECT DISTINCT question_id FROM context_hits) LEFT JOIN ({_CONTEXT_CHUNKS}) USING (question_id) GROUP BY question_id""",
        "context_hits",
        "vector_places",
    )
    out["source_list"] = _sql(
        f"""SELECT question_id, min(rank) AS rank, arg_min(title, rank) AS title, source FROM
 (SELECT question_id, rank, coalesce(title, '{NO_TITLE}') AS title, coalesce(source, '{NO_LINK}') AS source FROM hits LEFT JOIN chunk_sources USING (vec_id))
 GROUP BY question_id, source""",
        "hits",
        "chunk_sources",
    )
    return out
