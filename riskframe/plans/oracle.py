"""Reference SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code: null handling, zero guards and
type casts are spelled out in SQL here. Integer sums are cast to BIGINT
(DuckDB returns HUGEINT), date parts to INTEGER (DuckDB returns BIGINT), and
every DOUBLE output is rounded to ``DIGITS`` places, as the Spark side does,
because the order of floating-point additions differs between engines.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from riskframe.plans import tpch

DIGITS = 6
INT, BIG, DBL, STR = "INTEGER", "BIGINT", "DOUBLE", "VARCHAR"


@dataclass
class Col:
    name: str
    expr: str
    dtype: str


def final_select(cols: list[Col], source: str, extra: str = "") -> str:
    """Project ``cols`` from ``source``, rounding doubles."""
    parts = []
    for c in cols:
        e = f"ROUND({c.name}, {DIGITS})" if c.dtype == DBL else c.name
        parts.append(f"{e} AS {c.name}")
    return f"SELECT {', '.join(parts)} FROM {source} {extra}"


def safe_div(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) IS NOT NULL AND ({d}) <> 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END)"


def flag(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def clip0(x: str) -> str:
    return f"(CASE WHEN ({x}) < 0 THEN 0 ELSE ({x}) END)"


def nullif_sentinel(x: str, s) -> str:
    return f"(CASE WHEN ({x}) <> {s} THEN ({x}) END)"


@dataclass
class RollupSQL:
    prefix: str
    key: str
    source: str                      # FROM clause
    derived: list[Col] = field(default_factory=list)
    unique: str | None = None
    min_max: list[tuple[str, str]] = field(default_factory=list)   # (column, dtype)
    flags: list[tuple[str, str, bool]] = field(default_factory=list)  # (name, condition, rate)
    numerics: list[tuple[str, str]] = field(default_factory=list)  # (column, dtype)
    scales: dict[str, int] = field(default_factory=dict)           # column -> decimal places of its sum
    key_alias: str | None = None

    def columns(self) -> list[Col]:
        p = self.prefix
        out = [Col(f"{p}_RECORD_COUNT", "CAST(COUNT(*) AS BIGINT)", BIG)]
        if self.unique:
            u = self.unique
            out.append(Col(f"{p}_UNIQUE_LOAN_COUNT",
                           f"CAST(COUNT(DISTINCT {u}) + MAX(CASE WHEN {u} IS NULL THEN 1 ELSE 0 END) AS BIGINT)",
                           BIG))
        for c, t in self.min_max:
            out.append(Col(f"{p}_{c.upper()}_MIN", f"MIN({c})", t))
            out.append(Col(f"{p}_{c.upper()}_MAX", f"MAX({c})", t))
        for name, _cond, rate in self.flags:
            out.append(Col(f"{name}_COUNT", f"CAST(SUM({name}_FLAG) AS BIGINT)", BIG))
            if rate:
                out.append(Col(f"{name}_RATE", f"AVG({name}_FLAG)", DBL))
        for c, t in self.numerics:
            sum_t = DBL if t == DBL else BIG
            if c in self.scales:  # exact decimal sum, then a double
                total = f"CAST(SUM(CAST({c} AS DECIMAL(28, {self.scales[c]}))) AS DOUBLE)"
                out += [
                    Col(f"{p}_{c.upper()}_MEAN", f"{total} / COUNT({c})", DBL),
                    Col(f"{p}_{c.upper()}_MAX", f"MAX({c})", t),
                    Col(f"{p}_{c.upper()}_MIN", f"MIN({c})", t),
                    Col(f"{p}_{c.upper()}_SUM", f"COALESCE({total}, 0.0::DOUBLE)", DBL),
                ]
                continue
            out += [
                Col(f"{p}_{c.upper()}_MEAN", f"AVG({c})", DBL),
                Col(f"{p}_{c.upper()}_MAX", f"MAX({c})", t),
                Col(f"{p}_{c.upper()}_MIN", f"MIN({c})", t),
                Col(f"{p}_{c.upper()}_SUM", f"CAST(COALESCE(SUM({c}), 0) AS {sum_t})", sum_t),
            ]
        return out

    def sql(self) -> str:
        """Aggregate query: key + feature columns (unrounded)."""
        derived = [f"{d.expr} AS {d.name}" for d in self.derived]
        derived += [f"{flag(cond)} AS {name}_FLAG" for name, cond, _ in self.flags]
        inner = f"SELECT *{', ' if derived else ''}{', '.join(derived)} FROM {self.source}"
        key_out = f"{self.key} AS {self.key_alias}" if self.key_alias else self.key
        aggs = ", ".join(f"{c.expr} AS {c.name}" for c in self.columns())
        return f"SELECT {key_out}, {aggs} FROM ({inner}) GROUP BY {self.key}"

    def out_columns(self) -> list[Col]:
        return [Col(self.key_alias or self.key, self.key_alias or self.key, BIG)] + self.columns()


# ------------------------------------------------------------------ driver-table families

def bb_sql() -> RollupSQL:
    return RollupSQL(
        prefix="BB", key="l_orderkey", source="lineitem",
        min_max=[("l_linenumber", INT)],
        flags=[(f"BB_STATUS_{v}", f"l_returnflag = '{v}'", False) for v in tpch.RETURN_FLAGS])


def bureau_sql() -> RollupSQL:
    bb = bb_sql()
    bb_cols = [(c.name, c.dtype) for c in bb.columns()]
    source = f"orders LEFT JOIN ({bb.sql()}) bb ON orders.o_orderkey = bb.l_orderkey"
    return RollupSQL(
        prefix="BUREAU", key="o_custkey", source=source, unique="o_orderkey", key_alias="c_custkey",
        flags=[(f"BUREAU_{n}", f"o_orderstatus = '{v}'", False) for n, v in tpch.ORDER_STATUS.items()],
        numerics=[("o_totalprice", DBL), *bb_cols], scales=tpch.ORDER_SCALES)


def previous_sql() -> RollupSQL:
    day = "CAST(day(o_orderdate) AS INTEGER)"
    return RollupSQL(
        prefix="PREV", key="o_custkey", source="orders", unique="o_orderkey", key_alias="c_custkey",
        derived=[Col("ORDER_DAY", nullif_sentinel(day, tpch.ORDER_DAY_SENTINEL), INT),
                 Col("ORDER_MONTH", "CAST(month(o_orderdate) AS INTEGER)", INT),
                 Col("PREV_PRICE_DAY_RATIO", safe_div("o_totalprice", f"{day} - 1"), DBL)],
        flags=[(f"PREV_{n}", f"o_orderpriority = '{v}'", False) for n, v in tpch.PRIORITY_FLAGS.items()],
        numerics=[("o_totalprice", DBL), ("ORDER_DAY", INT), ("ORDER_MONTH", INT),
                  ("PREV_PRICE_DAY_RATIO", DBL)], scales=tpch.ORDER_SCALES)


def _dpd(prefix):
    return [(f"{prefix}_DPD", f"value > {tpch.DPD_THRESHOLD}", True),
            (f"{prefix}_DPD_30", f"value >= {tpch.DPD_30_THRESHOLD}", True),
            (f"{prefix}_DPD_DEF", f"value >= {tpch.DPD_DEF_THRESHOLD}", True)]


def pos_sql() -> RollupSQL:
    return RollupSQL(
        prefix="POS", key="user_id", source="events", unique="props", key_alias="c_custkey",
        derived=[Col("EVENT_HOUR", "CAST(hour(ts) AS INTEGER)", INT),
                 Col("EVENT_MONTH", "CAST(month(ts) AS INTEGER)", INT)],
        flags=[(f"POS_{n}", f"event_type = '{v}'", False) for n, v in tpch.POS_EVENT_FLAGS.items()] + _dpd("POS"),
        numerics=[("value", DBL), ("EVENT_HOUR", INT), ("EVENT_MONTH", INT)], scales=tpch.EVENT_SCALES)


def credit_card_sql() -> RollupSQL:
    return RollupSQL(
        prefix="CC", key="user_id", source="events", unique="props", key_alias="c_custkey",
        derived=[Col("EVENT_MINUTE", "CAST(minute(ts) AS INTEGER)", INT),
                 Col("CC_VALUE_HOUR_RATIO", safe_div("value", "CAST(hour(ts) AS INTEGER)"), DBL),
                 Col("CC_MINUTE_VALUE_RATIO", safe_div("CAST(minute(ts) AS INTEGER)", "value"), DBL)],
        flags=[(f"CC_{n}", f"event_type = '{v}'", False) for n, v in tpch.CC_EVENT_FLAGS.items()] + _dpd("CC"),
        numerics=[("value", DBL), ("EVENT_MINUTE", INT), ("CC_VALUE_HOUR_RATIO", DBL),
                  ("CC_MINUTE_VALUE_RATIO", DBL)], scales=tpch.EVENT_SCALES)


def installments_sql() -> RollupSQL:
    lag = "CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)"
    neg = "CAST(date_diff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER)"
    paid = "(l_extendedprice * (1.0::DOUBLE - l_discount))"
    return RollupSQL(
        prefix="INST", key="o_custkey", key_alias="c_custkey",
        source="(SELECT l.*, o.o_custkey, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)",
        unique="l_orderkey",
        derived=[Col("SHIP_LAG_DAYS", lag, INT),
                 Col("INST_PAYMENT_RATIO", safe_div(paid, "l_extendedprice"), DBL),
                 Col("INST_TAX_DISCOUNT_RATIO", safe_div("l_tax", "l_discount"), DBL),
                 Col("INST_PAYMENT_DIFF", f"(l_extendedprice - {paid})", DBL),
                 Col("INST_DPD", clip0(lag), INT),
                 Col("INST_DBD", clip0(neg), INT)],
        flags=[("INST_LATE", f"{lag} > 0", True), ("INST_LATE_30", f"{lag} >= 30", True),
               ("INST_UNDERPAY", f"{paid} < l_extendedprice", True)],
        numerics=[("l_quantity", DBL), ("l_extendedprice", DBL), ("l_discount", DBL), ("SHIP_LAG_DAYS", INT),
                  ("INST_PAYMENT_RATIO", DBL), ("INST_TAX_DISCOUNT_RATIO", DBL), ("INST_PAYMENT_DIFF", DBL),
                  ("INST_DPD", INT), ("INST_DBD", INT)], scales=tpch.LINE_SCALES)


FAMILY_SQL = {
    "bureau": bureau_sql,
    "previous_application": previous_sql,
    "pos_cash": pos_sql,
    "credit_card": credit_card_sql,
    "installments": installments_sql,
}


def family_query(name: str) -> str:
    r = FAMILY_SQL[name]()
    return final_select(r.out_columns(), f"({r.sql()}) t")


APPLICANT_COLS = [
    Col("c_custkey", "c_custkey", BIG), Col("c_nationkey", "c_nationkey", INT),
    Col("n_regionkey", "n_regionkey", INT), Col("c_mktsegment", "c_mktsegment", STR),
    Col("n_name", "n_name", STR),
    Col("APP_NATION_REGION_RATIO", safe_div("c_nationkey", "n_regionkey"), DBL),
    Col("APP_REGION_NATION_RATIO", safe_div("n_regionkey", "c_nationkey"), DBL),
    Col("TARGET", "CAST(c_acctbal < 0 AS INTEGER)", INT),
]


def applicants_sql() -> str:
    sel = ", ".join(f"{c.expr} AS {c.name}" for c in APPLICANT_COLS)
    return f"SELECT {sel} FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"


def applicant_features_sql() -> tuple[str, list[Col]]:
    """Unrounded applicant table SQL and its typed column list."""
    cols = list(APPLICANT_COLS)
    joins = []
    for i, name in enumerate(FAMILY_SQL):
        r = FAMILY_SQL[name]()
        joins.append(f"LEFT JOIN ({r.sql()}) f{i} USING (c_custkey)")
        cols += r.columns()
    return f"SELECT * FROM ({applicants_sql()}) a {' '.join(joins)}", cols


def applicant_features_query() -> str:
    sql, cols = applicant_features_sql()
    return final_select(cols, f"({sql}) t")


# ------------------------------------------------------------------ profiling / preparation SQL

def app_cte() -> str:
    return f"app AS ({applicant_features_sql()[0]})"


def app_columns() -> list[Col]:
    return applicant_features_sql()[1]


def split_cte(seed: int = 42, test_size: float = 0.2) -> str:
    return (f"split AS (SELECT c_custkey, TARGET, CASE WHEN ROW_NUMBER() OVER (PARTITION BY TARGET "
            f"ORDER BY md5('{seed}:' || CAST(c_custkey AS VARCHAR)), c_custkey) <= "
            f"ROUND({test_size}::DOUBLE * COUNT(*) OVER (PARTITION BY TARGET)) THEN 'validation' "
            f"ELSE 'train' END AS split FROM ({applicants_sql()}) a)")


def null_rows(cols: list[Col], source: str, pct_name: str = "null_pct") -> str:
    parts = [f"SELECT '{c.name}' AS column, {i} AS ordinal, "
             f"CAST(SUM(CASE WHEN {c.name} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count, "
             f"100.0::DOUBLE * SUM(CASE WHEN {c.name} IS NULL THEN 1 ELSE 0 END) / COUNT(*) AS {pct_name} "
             f"FROM {source}" for i, c in enumerate(cols)]
    return " UNION ALL ".join(parts)


def missing_profile_sql() -> str:
    return (f"WITH {app_cte()} SELECT \"column\", ordinal, null_count, ROUND(null_pct, {DIGITS}) AS null_pct "
            f"FROM ({null_rows(app_columns(), 'app')})")


def top_missing_sql(n: int = 12) -> str:
    return (f"WITH {app_cte()} SELECT \"column\", ordinal, null_count, ROUND(null_pct, {DIGITS}) AS null_pct "
            f"FROM ({null_rows(app_columns(), 'app')}) ORDER BY null_pct DESC, ordinal LIMIT {n}")


def numeric_cols(cols: list[Col], exclude=()) -> list[Col]:
    return [c for c in cols if c.dtype != STR and c.name not in exclude]


def missing_train_test_sql() -> str:
    cols = app_columns()
    train = "(SELECT * FROM app WHERE c_custkey IN (SELECT c_custkey FROM split WHERE split = 'train'))"
    test = "(SELECT * FROM app WHERE c_custkey IN (SELECT c_custkey FROM split WHERE split = 'validation'))"
    tr = null_rows(cols, train, "train_missing_pct")
    te = null_rows([c for c in cols if c.name != "TARGET"], test, "test_missing_pct")
    return (f"WITH {app_cte()}, {split_cte()} SELECT tr.\"column\", tr.ordinal, "
            f"ROUND(tr.train_missing_pct, {DIGITS}) AS train_missing_pct, "
            f"ROUND(COALESCE(te.test_missing_pct, 0.0::DOUBLE), {DIGITS}) AS test_missing_pct "
            f"FROM ({tr}) tr LEFT JOIN ({te}) te ON tr.\"column\" = te.\"column\"")


def constant_columns_sql() -> str:
    parts = [f"SELECT '{c.name}' AS column, {i} AS ordinal, (COUNT({c.name}) = 0 OR (COUNT({c.name}) = COUNT(*) "
             f"AND MIN({c.name}) = MAX({c.name}))) AS is_constant FROM app" for i, c in enumerate(app_columns())]
    return f"WITH {app_cte()} " + " UNION ALL ".join(parts)


def schema_summary_sql() -> str:
    cols = app_columns()
    n_cat = sum(1 for c in cols if c.dtype == STR)
    return (f"WITH {app_cte()} SELECT 'applicant_features' AS table_name, COUNT(*) AS rows, "
            f"{len(cols)} AS columns, {len(cols) - n_cat} AS numeric_columns, {n_cat} AS categorical_columns FROM app")


def dtype_counts_sql() -> str:
    names = {INT: "int", BIG: "bigint", DBL: "double", STR: "string"}
    counts: dict[str, int] = {}
    for c in app_columns():
        counts[names[c.dtype]] = counts.get(names[c.dtype], 0) + 1
    values = ", ".join(f"('{t}', {n})" for t, n in counts.items())
    return (f"SELECT dtype, CAST(n AS BIGINT) AS columns, (SELECT COUNT(*) FROM customer) AS rows FROM (VALUES {values}) v(dtype, n)")


def schema_diff_sql() -> str:
    right_cols = [c for c in APPLICANT_COLS if c.name != "TARGET"]
    left = null_rows(app_columns(), "app")
    right = null_rows(right_cols, "apps")
    return (f"WITH {app_cte()}, apps AS ({applicants_sql()}) "
            f"SELECT COALESCE(l.\"column\", r.\"column\") AS \"column\", l.\"column\" IS NOT NULL AS in_left, "
            f"r.\"column\" IS NOT NULL AS in_right, l.null_count AS left_nulls, r.null_count AS right_nulls "
            f"FROM ({left}) l FULL JOIN ({right}) r ON l.\"column\" = r.\"column\"")


def table_overview_sql(tables: dict[str, str]) -> str:
    parts = []
    for t, idc in tables.items():
        meta = (f"(SELECT CAST(COUNT(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}')")
        sample = (f"(SELECT string_agg(column_name, ', ' ORDER BY ordinal_position) FROM information_schema.columns "
                  f"WHERE table_name = '{t}' AND ordinal_position <= 8)")
        parts.append(f"SELECT '{t}' AS table_name, '{idc}' AS id_col, COUNT(*) AS rows, {meta} AS cols, "
                     f"{sample} AS sample_columns FROM {t}")
    return " UNION ALL ".join(parts)


def status_counts_sql(sources) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column, CAST({c} AS VARCHAR) AS value, COUNT(*) AS count "
        f"FROM {t} GROUP BY {c}" for t, c in sources)


def records_per_id_sql(sources) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS id_col, COUNT(*) AS unique_ids, ROUND(AVG(n), {DIGITS}) AS mean_records, "
        f"ROUND(CAST(quantile_cont(n, 0.5) AS DOUBLE), {DIGITS}) AS median_records, "
        f"ROUND(CAST(quantile_cont(n, 0.95) AS DOUBLE), {DIGITS}) AS p95_records, MAX(n) AS max_records "
        f"FROM (SELECT {c}, COUNT(*) AS n FROM {t} GROUP BY {c})" for t, c in sources)


def target_balance_sql() -> str:
    return (f"SELECT TARGET, COUNT(*) AS count, ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), {DIGITS}) "
            f"AS proportion FROM ({applicants_sql()}) a WHERE TARGET IS NOT NULL GROUP BY TARGET")


def rate_by_category_sql(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category, ROUND(AVG(TARGET), {DIGITS}) AS rate, COUNT(*) AS n "
        f"FROM ({applicants_sql()}) a WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns)


def categorical_cardinality_sql(table: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT(DISTINCT {c}) AS n_unique FROM {table}"
                              for c in columns)


def describe_sql(table: str, columns) -> str:
    r = lambda e: f"ROUND(CAST({e} AS DOUBLE), {DIGITS})"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT({c}) AS count, {r(f'AVG({c})')} AS mean, {r(f'STDDEV_SAMP({c})')} AS std, "
        f"{r(f'MIN({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50, "
        f"{r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'MAX({c})')} AS max FROM {table}" for c in columns)


def correlation_sql(columns) -> str:
    parts = []
    for a in columns:
        for b in columns:
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                         f"ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {DIGITS}) AS corr FROM app")
    return f"WITH {app_cte()} " + " UNION ALL ".join(parts)


def histogram_sql(table: str, column: str, bins: int) -> str:
    b = float(bins)
    return (f"WITH v AS (SELECT CAST({column} AS DOUBLE) AS x FROM {table} WHERE {column} IS NOT NULL), "
            f"r0 AS (SELECT MIN(x) AS lo0, MAX(x) AS hi0 FROM v), "
            f"r AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, "
            f"CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0), "
            f"c AS (SELECT LEAST(CAST(FLOOR((x - lo) * {b}::DOUBLE / (hi - lo)) AS INTEGER), {bins - 1}) AS bin, "
            f"COUNT(*) AS count FROM v, r GROUP BY 1), "
            f"g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins})) "
            f"SELECT g.bin, ROUND(lo + g.bin * ((hi - lo) / {b}::DOUBLE), {DIGITS}) AS lower, "
            f"ROUND(lo + (g.bin + 1) * ((hi - lo) / {b}::DOUBLE), {DIGITS}) AS upper, "
            f"COALESCE(c.count, 0) AS count FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin")


def box_stats_sql() -> str:
    src = "(SELECT CAST(l_returnflag = 'R' AS INTEGER) AS is_returned, l_extendedprice AS x FROM lineitem)"
    return (f"WITH q AS (SELECT is_returned, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, "
            f"quantile_cont(x, 0.75) AS q3 FROM {src} GROUP BY 1), "
            f"f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q) "
            f"SELECT s.is_returned, ROUND(q1, {DIGITS}) AS q1, ROUND(median, {DIGITS}) AS median, "
            f"ROUND(q3, {DIGITS}) AS q3, ROUND(iqr, {DIGITS}) AS iqr, "
            f"ROUND(MIN(CASE WHEN x >= lo_f AND x <= hi_f THEN x END), {DIGITS}) AS whisker_low, "
            f"ROUND(MAX(CASE WHEN x >= lo_f AND x <= hi_f THEN x END), {DIGITS}) AS whisker_high, "
            f"CAST(SUM(CASE WHEN x >= lo_f AND x <= hi_f THEN 0 ELSE 1 END) AS BIGINT) AS outliers "
            f"FROM {src} s JOIN f ON s.is_returned = f.is_returned GROUP BY s.is_returned, q1, median, q3, iqr")


def class_weights_sql() -> str:
    return (f"WITH c AS (SELECT TARGET, COUNT(*) AS n FROM ({applicants_sql()}) a GROUP BY TARGET), "
            f"t AS (SELECT SUM(n) AS tn, COUNT(*) AS k, SUM(CASE WHEN TARGET = 0 THEN n END) AS neg, "
            f"SUM(CASE WHEN TARGET = 1 THEN n END) AS pos FROM c) "
            f"SELECT TARGET, n, ROUND(CAST(tn AS DOUBLE) / (k * n), {DIGITS}) AS balanced_weight, "
            f"ROUND(CASE WHEN pos > 0 THEN CAST(neg AS DOUBLE) / pos END, {DIGITS}) AS scale_pos_weight FROM c, t")


def clip_at_quantile_sql() -> str:
    return (f"WITH c AS (SELECT o_custkey, COUNT(*) AS record_count FROM orders GROUP BY 1), "
            f"q AS (SELECT quantile_cont(record_count, 0.99) AS q FROM c) "
            f"SELECT o_custkey, record_count, ROUND(CASE WHEN record_count > q THEN q ELSE CAST(record_count AS DOUBLE) "
            f"END, {DIGITS}) AS clipped FROM c, q")


def stratified_split_sql() -> str:
    return f"WITH {split_cte()} SELECT c_custkey, TARGET, split FROM split"


def split_semi_join_sql() -> str:
    return (f"WITH {app_cte()}, {split_cte()} SELECT c_custkey, TARGET, BUREAU_RECORD_COUNT, INST_INST_DPD_SUM "
            f"FROM app WHERE c_custkey IN (SELECT c_custkey FROM split WHERE split = 'train')")


def sample_n_sql(n: int = 200, seed: int = 42) -> str:
    return (f"SELECT c_custkey, TARGET FROM ({applicants_sql()}) a "
            f"ORDER BY md5('{seed}:' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT {n}")


def impute_median_sql() -> str:
    num = numeric_cols(app_columns(), exclude=("c_custkey", "TARGET"))
    sel = ", ".join(f"ROUND(COALESCE(CAST({c.name} AS DOUBLE), (SELECT quantile_cont(CAST({c.name} AS DOUBLE), 0.5) "
                    f"FROM app)), {DIGITS}) AS {c.name}" for c in num)
    return f"WITH {app_cte()} SELECT c_custkey, {sel} FROM app"


def impute_mode_sql(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, (SELECT CAST({c} AS VARCHAR) FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS mode" for c in columns)


EPS = 2.220446049250313e-16


def scale_expr(x: str) -> str:
    """Population std, 1 when undefined or zero up to floating-point error."""
    var, n = f"VAR_POP({x})", f"CAST(COUNT({x}) AS DOUBLE)"
    const = f"{var} <= {n} * {EPS!r}::DOUBLE * {var} + POWER({n} * AVG({x}) * {EPS!r}::DOUBLE, 2)"
    return f"CASE WHEN {var} IS NULL OR {const} THEN 1.0::DOUBLE ELSE SQRT({var}) END"


def standardize_sql() -> str:
    num = numeric_cols(app_columns(), exclude=("c_custkey", "TARGET"))
    med = ", ".join(f"quantile_cont(CAST({c.name} AS DOUBLE), 0.5) AS m_{i}" for i, c in enumerate(num))
    parts = []
    for i, c in enumerate(num):
        x = f"COALESCE(CAST({c.name} AS DOUBLE), m_{i})"
        parts.append(f"SELECT '{c.name}' AS column, ROUND(COALESCE(AVG({x}), 0.0::DOUBLE), {DIGITS}) AS mean, "
                     f"ROUND({scale_expr(x)}, {DIGITS}) AS scale FROM app, med")
    return f"WITH {app_cte()}, med AS (SELECT {med} FROM app) " + " UNION ALL ".join(parts)


def one_hot_sql(columns) -> str:
    src = f"({applicants_sql()}) a"
    return " UNION ALL ".join(
        f"SELECT '{c}_' || COALESCE(CAST({c} AS VARCHAR), 'None') AS feature, CAST(COUNT(*) AS DOUBLE) AS ones, "
        f"(SELECT COUNT(*) FROM {src}) AS rows FROM {src} GROUP BY {c}" for c in columns)


def ready_summary_sql(scale: bool) -> str:
    """Per output feature: non-null count, min, max of the ready table
    (train part when ``scale`` is False, validation part transformed with the
    train fit when True)."""
    cols = app_columns()
    feats = [c for c in cols if c.name not in ("c_custkey", "TARGET")]
    train = "(SELECT * FROM app WHERE c_custkey IN (SELECT c_custkey FROM split WHERE split = 'train'))"
    test = "(SELECT * FROM app WHERE c_custkey IN (SELECT c_custkey FROM split WHERE split = 'validation'))"
    target = test if scale else train
    ctes = [app_cte(), split_cte(), f"tr AS {train}", f"ev AS {target}"]
    keep = [f"NOT (COUNT({c.name}) = 0 OR (COUNT({c.name}) = COUNT(*) AND MIN({c.name}) = MAX({c.name}))) AS k_{i}"
            for i, c in enumerate(feats)]
    ctes.append(f"keep AS (SELECT {', '.join(keep)} FROM tr)")
    num = [(i, c) for i, c in enumerate(feats) if c.dtype != STR]
    fit = [f"quantile_cont(CAST({c.name} AS DOUBLE), 0.5) AS m_{i}" for i, c in num]
    ctes.append(f"med AS (SELECT {', '.join(fit)} FROM tr)")
    if scale:
        sc = []
        for i, c in num:
            x = f"COALESCE(CAST({c.name} AS DOUBLE), m_{i})"
            sc += [f"COALESCE(AVG({x}), 0.0::DOUBLE) AS a_{i}", f"{scale_expr(x)} AS s_{i}"]
        ctes.append(f"sc AS (SELECT {', '.join(sc)} FROM tr, med)")
    parts = []
    for i, c in num:
        x = f"COALESCE(CAST({c.name} AS DOUBLE), m_{i})"
        if scale:
            x = f"(({x} - a_{i}) / s_{i})"
        src = "ev, med, keep" + (", sc" if scale else "")
        parts.append(f"SELECT '{c.name}' AS feature, COUNT({x}) AS n, ROUND(MIN({x}), {DIGITS}) AS min_value, "
                     f"ROUND(MAX({x}), {DIGITS}) AS max_value FROM {src} WHERE k_{i} GROUP BY k_{i}")
    for i, c in enumerate(feats):
        if c.dtype != STR:
            continue
        cats = (f"(SELECT DISTINCT {c.name} AS v FROM tr)")
        hit = f"(CASE WHEN ev.{c.name} IS NOT DISTINCT FROM cats.v THEN 1.0 ELSE 0.0 END)"
        parts.append(f"SELECT '{c.name}_' || COALESCE(cats.v, 'None') AS feature, COUNT(*) AS n, "
                     f"CAST(MIN({hit}) AS DOUBLE) AS min_value, CAST(MAX({hit}) AS DOUBLE) AS max_value "
                     f"FROM ev CROSS JOIN {cats} cats, keep WHERE k_{i} GROUP BY cats.v")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


# ------------------------------------------------------------------ evaluation SQL

SCORES_CTE = ("s AS (SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label, "
              "l_quantity * 0.02::DOUBLE AS score_quantity, l_discount * 10.0::DOUBLE AS score_discount, "
              "l_tax * 12.5::DOUBLE AS score_tax FROM lineitem)")
MODELS = ("quantity", "discount", "tax")


def long_cte(with_blend: bool = False, extra: str = "") -> str:
    parts = [f"SELECT '{m}' AS model, l_orderkey, l_linenumber, label, score_{m} AS score{extra} FROM s"
             for m in MODELS]
    if with_blend:
        parts.append(f"SELECT 'blend' AS model, l_orderkey, l_linenumber, label, "
                     f"0.8::DOUBLE * score_quantity + (1.0::DOUBLE - 0.8::DOUBLE) * score_discount AS score{extra} "
                     f"FROM s")
    return f"lng AS ({' UNION ALL '.join(parts)})"


def grid_sql(step: float, n: int) -> str:
    return f"SELECT 0.05::DOUBLE + i * ((0.05::DOUBLE + {step}::DOUBLE) - 0.05::DOUBLE) AS threshold FROM range({n}) t(i)"


def ratio(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE 0.0::DOUBLE END)"


def conf_cols(tp="tp", fp="fp", P="P", N="N") -> str:
    fn, tn = f"({P} - {tp})", f"({N} - {fp})"
    return (f"{ratio(f'{tp} + {tn}', f'{P} + {N}')} AS accuracy, {ratio(tp, f'{tp} + {fp}')} AS precision, "
            f"{ratio(tp, P)} AS recall, {ratio(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1")


def rank_ctes(g: str, src: str = "lng") -> str:
    """ps, cum, rnk CTEs for group columns ``g`` (comma list)."""
    return (f"ps AS (SELECT {g}, score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM {src} GROUP BY {g}, score), "
            f"cum AS (SELECT *, SUM(pos) OVER (PARTITION BY {g} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_tp, "
            f"SUM(neg) OVER (PARTITION BY {g} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_fp FROM ps), "
            f"rnk AS (SELECT {g}, CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN "
            f"SUM(CAST(neg AS DOUBLE) * (CAST(cum_tp AS DOUBLE) - CAST(pos AS DOUBLE) / 2.0::DOUBLE)) "
            f"/ (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) END AS roc_auc, "
            f"CASE WHEN SUM(pos) > 0 THEN SUM(CAST(pos AS DOUBLE) * (CAST(cum_tp AS DOUBLE) / CAST(cum_tp + cum_fp AS DOUBLE))) "
            f"/ CAST(SUM(pos) AS DOUBLE) END AS average_precision FROM cum GROUP BY {g})")


def at_threshold_cte(g: str, t: str = "0.5::DOUBLE", src: str = "lng", name: str = "bm") -> str:
    return (f"{name}0 AS (SELECT {g}, SUM(CASE WHEN label = 1 AND score >= {t} THEN 1 ELSE 0 END) AS tp, "
            f"SUM(CASE WHEN label = 0 AND score >= {t} THEN 1 ELSE 0 END) AS fp, SUM(label) AS P, "
            f"COUNT(*) - SUM(label) AS N FROM {src} GROUP BY {g}), "
            f"{name} AS (SELECT {g}, {conf_cols()} FROM {name}0)")


def table_ctes(g: str, step: float, n: int, src: str = "lng", name: str = "tt") -> str:
    return (f"{name}g AS ({grid_sql(step, n)}), "
            f"{name}0 AS (SELECT p.{g.replace(', ', ', p.')}, gr.threshold, "
            f"CAST(SUM(CASE WHEN p.score >= gr.threshold THEN p.pos ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(SUM(CASE WHEN p.score >= gr.threshold THEN p.neg ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(SUM(p.pos) AS BIGINT) AS P, CAST(SUM(p.neg) AS BIGINT) AS N FROM ps p CROSS JOIN {name}g gr "
            f"GROUP BY p.{g.replace(', ', ', p.')}, gr.threshold), "
            f"{name} AS (SELECT t.*, t.P - t.tp AS fn, t.N - t.fp AS tn, {conf_cols('t.tp', 't.fp', 't.P', 't.N')}, "
            f"r.roc_auc, r.average_precision FROM {name}0 t JOIN rnk r USING ({g}))")


def rnd(cols: list[str]) -> str:
    return ", ".join(f"ROUND({c}, {DIGITS}) AS {c}" for c in cols)


METRIC_COLS = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


def binary_metrics_sql() -> str:
    return (f"WITH {SCORES_CTE}, {long_cte()}, {rank_ctes('model')}, {at_threshold_cte('model')} "
            f"SELECT model, {rnd(METRIC_COLS)} FROM bm JOIN rnk USING (model)")


def roc_auc_sql() -> str:
    return f"WITH {SCORES_CTE}, {long_cte()}, {rank_ctes('model')} SELECT model, {rnd(['roc_auc'])} FROM rnk"


def average_precision_sql() -> str:
    return (f"WITH {SCORES_CTE}, {long_cte()}, {rank_ctes('model')} "
            f"SELECT model, {rnd(['average_precision'])} FROM rnk")


def pr_curve_sql() -> str:
    return (f"WITH {SCORES_CTE}, {long_cte()}, {rank_ctes('model')} "
            f"SELECT model, ROUND(CAST(cum_tp AS DOUBLE) / CAST(cum_tp + cum_fp AS DOUBLE), {DIGITS}) AS precision, "
            f"ROUND(CASE WHEN SUM(pos) OVER (PARTITION BY model) > 0 THEN CAST(cum_tp AS DOUBLE) / "
            f"CAST(SUM(pos) OVER (PARTITION BY model) AS DOUBLE) END, {DIGITS}) AS recall, "
            f"ROUND(score, {DIGITS}) AS threshold FROM cum")


TT_COLS = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


def threshold_table_sql() -> str:
    return (f"WITH {SCORES_CTE}, {long_cte()}, {rank_ctes('model')}, {table_ctes('model', 0.05, 19)} "
            f"SELECT model, ROUND(threshold, {DIGITS}) AS threshold, tp, fp, fn, tn, {rnd(TT_COLS)} FROM tt")


def best_f1_sql(g: str = "model", src_ctes: str | None = None) -> str:
    src = src_ctes or f"{SCORES_CTE}, {long_cte()}"
    return (f"WITH {src}, {rank_ctes(g)}, {table_ctes(g, 0.01, 91)}, "
            f"b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY f1 DESC, threshold) AS rn FROM tt) "
            f"SELECT {g}, {rnd(METRIC_COLS)}, ROUND(threshold, {DIGITS}) AS threshold, "
            f"ROUND(f1, {DIGITS}) AS best_f1_from_sweep FROM b WHERE rn = 1")


def target_precision_sql(target: float = 0.30) -> str:
    ok = f"CASE WHEN precision >= {target}::DOUBLE THEN 1 ELSE 0 END"
    return (f"WITH {SCORES_CTE}, {long_cte()}, {rank_ctes('model')}, {table_ctes('model', 0.05, 19)}, "
            f"e AS (SELECT *, {ok} AS ok, MAX({ok}) OVER (PARTITION BY model) AS any_ok FROM tt), "
            f"b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY ok DESC, "
            f"CASE WHEN any_ok = 1 THEN recall ELSE precision END DESC, "
            f"CASE WHEN any_ok = 1 THEN f1 ELSE 0.0 END DESC, threshold) AS rn FROM e) "
            f"SELECT model, ROUND(threshold, {DIGITS}) AS threshold, tp, fp, fn, tn, {rnd(TT_COLS)} FROM b WHERE rn = 1")


def blend_scores_sql() -> str:
    return (f"WITH {SCORES_CTE} SELECT l_orderkey, l_linenumber, label, "
            f"ROUND(0.8::DOUBLE * score_quantity + (1.0::DOUBLE - 0.8::DOUBLE) * score_discount, {DIGITS}) AS score FROM s")


def score_alignment_sql() -> str:
    k = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    side = (lambda name: f"(SELECT {', '.join(k)}, CAST(l_returnflag = 'R' AS INTEGER) AS lab, 1 AS present "
            f"FROM lineitem) {name}")
    on = " AND ".join(f"a.{c} = b.{c}" for c in k)
    both = "(a.present IS NOT NULL AND b.present IS NOT NULL)"
    return (f"SELECT CAST(SUM(CASE WHEN {both} THEN 1 ELSE 0 END) AS BIGINT) AS aligned, "
            f"CAST(SUM(CASE WHEN {both} AND a.lab IS DISTINCT FROM b.lab THEN 1 ELSE 0 END) AS BIGINT) AS label_mismatches, "
            f"CAST(SUM(CASE WHEN b.present IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS primary_only, "
            f"CAST(SUM(CASE WHEN a.present IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS secondary_only "
            f"FROM {side('a')} FULL JOIN {side('b')} ON {on}")


def blend_sweep_sql() -> str:
    w = "(VALUES (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE), (0.8::DOUBLE), (0.9::DOUBLE)) wv(primary_weight)"
    lng = (f"lng AS (SELECT primary_weight, l_orderkey, l_linenumber, label, "
           f"primary_weight * score_quantity + (1.0::DOUBLE - primary_weight) * score_discount AS score "
           f"FROM s CROSS JOIN {w})")
    g = "primary_weight"
    return (f"WITH {SCORES_CTE}, {lng}, {rank_ctes(g)}, {at_threshold_cte(g)}, {table_ctes(g, 0.01, 91)}, "
            f"b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY f1 DESC, threshold) AS rn FROM tt) "
            f"SELECT bm.primary_weight, ROUND(1.0::DOUBLE - bm.primary_weight, {DIGITS}) AS secondary_weight, "
            f"ROUND(r.roc_auc, {DIGITS}) AS roc_auc, ROUND(r.average_precision, {DIGITS}) AS average_precision, "
            f"ROUND(bm.f1, {DIGITS}) AS default_f1, ROUND(b.f1, {DIGITS}) AS tuned_f1, "
            f"ROUND(b.precision, {DIGITS}) AS tuned_precision, ROUND(b.recall, {DIGITS}) AS tuned_recall, "
            f"ROUND(b.threshold, {DIGITS}) AS tuned_threshold, "
            f"printf('quantity %.1f + discount %.1f', bm.primary_weight, 1.0::DOUBLE - bm.primary_weight) AS label "
            f"FROM bm JOIN rnk r USING ({g}) "
            f"JOIN b ON b.{g} = bm.{g} AND b.rn = 1")


def leaderboard_sql() -> str:
    g = "model"
    return (f"WITH {SCORES_CTE}, {long_cte(with_blend=True)}, {rank_ctes(g)}, {at_threshold_cte(g)}, "
            f"{table_ctes(g, 0.01, 91)}, "
            f"b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY f1 DESC, threshold) AS rn FROM tt) "
            f"SELECT 'default' AS kind, model, {rnd(METRIC_COLS)}, 0.5::DOUBLE AS threshold FROM bm JOIN rnk USING (model) "
            f"UNION ALL SELECT 'tuned' AS kind, model, {rnd(METRIC_COLS)}, ROUND(threshold, {DIGITS}) AS threshold "
            f"FROM b WHERE rn = 1")


def stratified_folds_sql(k: int = 5, seed: int = 42) -> str:
    ends = " + ".join(f"CASE WHEN rn > ROUND({i / k!r}::DOUBLE * n) THEN 1 ELSE 0 END" for i in range(1, k))
    return (f"SELECT c_custkey, TARGET, CAST({ends} AS INTEGER) AS fold FROM (SELECT c_custkey, TARGET, COUNT(*) OVER (PARTITION BY TARGET) AS n, "
            f"ROW_NUMBER() OVER (PARTITION BY TARGET ORDER BY md5('{seed}:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS rn FROM ({applicants_sql()}) a)")


def fold_records_sql(folds: int = 5) -> str:
    fold = (f"CAST((CAST('0x' || substr(md5('fold:' || CAST(l_orderkey AS VARCHAR) || ':' || "
            f"CAST(l_linenumber AS VARCHAR)), 1, 8) AS BIGINT) % {folds}) AS INTEGER)")
    values = ", ".join(f"ROUND({'r' if c in ('roc_auc', 'average_precision') else 'bm'}.{c}, {DIGITS}) AS {c}" for c in METRIC_COLS)
    return (f"WITH {SCORES_CTE}, {long_cte(extra=', ' + fold + ' AS fold')}, {rank_ctes('model, fold')}, {at_threshold_cte('model, fold')} "
            f"SELECT bm.model, 'lineitem_scores' AS experiment, bm.fold, {values}, {folds} AS folds FROM bm JOIN rnk r ON bm.model = r.model AND bm.fold = r.fold")


def fold_summary_sql(folds: int = 5) -> str:
    fold = (f"CAST((CAST('0x' || substr(md5('fold:' || CAST(l_orderkey AS VARCHAR) || ':' || "
            f"CAST(l_linenumber AS VARCHAR)), 1, 8) AS BIGINT) % {folds}) AS INTEGER)")
    g = "model, fold"
    per = (f"pf AS (SELECT bm.model, bm.fold, bm.accuracy, bm.precision, bm.recall, bm.f1, r.roc_auc, "
           f"r.average_precision FROM bm JOIN rnk r ON bm.model = r.model AND bm.fold = r.fold)")
    aggs = ", ".join(f"ROUND(AVG({c}), {DIGITS}) AS {c}_mean, ROUND(STDDEV_SAMP({c}), {DIGITS}) AS {c}_std"
                     for c in METRIC_COLS)
    return (f"WITH {SCORES_CTE}, {long_cte(extra=', ' + fold + ' AS fold')}, {rank_ctes(g)}, {at_threshold_cte(g)}, "
            f"{per} SELECT 'lineitem_scores' AS experiment, model, {aggs} FROM pf GROUP BY model")


# ------------------------------------------------------------------ expression / component / I/O SQL

LKEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def derived_columns_sql() -> str:
    return final_select(APPLICANT_COLS, f"({applicants_sql()}) a")


def sentinel_sql() -> str:
    day = "CAST(day(o_orderdate) AS INTEGER)"
    return f"SELECT o_orderkey, {nullif_sentinel(day, tpch.ORDER_DAY_SENTINEL)} AS ORDER_DAY FROM orders"


def safe_ratio_sql() -> str:
    return f"SELECT {LKEYS}, ROUND({safe_div('l_tax', 'l_discount')}, {DIGITS}) AS tax_discount_ratio FROM lineitem"


def status_flags_sql() -> str:
    f = [f"{flag(f'l_returnflag = {v!r}')} AS RETURN_{v}_FLAG" for v in tpch.RETURN_FLAGS]
    f += [f"{flag(f'l_linestatus = {v!r}')} AS LINE_{v}_FLAG" for v in ("O", "F")]
    return f"SELECT {LKEYS}, {', '.join(f)} FROM lineitem"


def threshold_flags_sql() -> str:
    return (f"SELECT event_id, {flag(f'value > {tpch.DPD_THRESHOLD}')} AS DPD_FLAG, "
            f"{flag(f'value >= {tpch.DPD_30_THRESHOLD}')} AS DPD_30_FLAG, "
            f"{flag(f'value >= {tpch.DPD_DEF_THRESHOLD}')} AS DPD_DEF_FLAG FROM events")


def payment_lateness_sql() -> str:
    lag = "CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)"
    neg = "CAST(date_diff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER)"
    return (f"SELECT {LKEYS}, {lag} AS SHIP_LAG_DAYS, {clip0(lag)} AS DAYS_PAST_DUE, {clip0(neg)} AS DAYS_BEFORE_DUE "
            f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def row_stats_sql() -> str:
    a = "(CASE WHEN l_discount <> 0.0 THEN l_discount END)"
    b, c = "l_tax", "(l_quantity / 50.0::DOUBLE)"
    cnt = " + ".join(f"(CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END)" for x in (a, b, c))
    tot = " + ".join(f"COALESCE({x}, 0.0::DOUBLE)" for x in (a, b, c))
    return (f"SELECT {LKEYS}, ROUND(CASE WHEN {cnt} > 0 THEN (0.0::DOUBLE + {tot}) / ({cnt}) END, {DIGITS}) AS ROW_MEAN, "
            f"ROUND(LEAST({a}, {b}, {c}), {DIGITS}) AS ROW_MIN, ROUND(GREATEST({a}, {b}, {c}), {DIGITS}) AS ROW_MAX "
            f"FROM lineitem")


def age_years_sql(ref: str) -> str:
    days = f"CAST(date_diff('day', DATE '{ref}', CAST(o_orderdate AS DATE)) AS INTEGER)"
    return (f"SELECT o_orderkey, {days} AS DAYS_ORDER, ROUND(CAST(-{days} AS DOUBLE) / 365.0::DOUBLE, {DIGITS}) "
            f"AS YEARS_ORDER FROM orders")


def group_count_sql() -> str:
    return "SELECT o_custkey, COUNT(*) AS ORDERS_RECORD_COUNT FROM orders GROUP BY o_custkey"


def unique_count_sql() -> str:
    return ("SELECT l_orderkey, COUNT(*) AS LINES_RECORD_COUNT, CAST(COUNT(DISTINCT l_partkey) + "
            "MAX(CASE WHEN l_partkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS LINES_UNIQUE_PART_COUNT "
            "FROM lineitem GROUP BY l_orderkey")


def status_counts_per_parent_sql() -> str:
    r = bb_sql()
    return final_select(r.out_columns(), f"({r.sql()}) t")


def flag_rollup_sql() -> str:
    r = RollupSQL(prefix="EV", key="user_id", source="events", flags=[
        ("EV_DPD", f"value > {tpch.DPD_THRESHOLD}", True), ("EV_DPD_30", f"value >= {tpch.DPD_30_THRESHOLD}", True),
        ("EV_DPD_DEF", f"value >= {tpch.DPD_DEF_THRESHOLD}", True)])
    return final_select(r.out_columns(), f"({r.sql()}) t")


def numeric_stat_pack_sql() -> str:
    r = RollupSQL(prefix="ORDERS", key="o_custkey", source="orders", numerics=[("o_totalprice", DBL)], scales=tpch.ORDER_SCALES)
    return final_select(r.out_columns(), f"({r.sql()}) t")


def safe_names_sql() -> str:
    names = ("SELECT DISTINCT name FROM (SELECT 'o_orderpriority_' || COALESCE(o_orderpriority, 'None') AS name "
             "FROM orders UNION ALL SELECT 'o_orderstatus_' || COALESCE(o_orderstatus, 'None') FROM orders)")
    base = "trim(regexp_replace(name, '[^A-Za-z0-9_]+', '_', 'g'), '_')"
    return (f"WITH n AS ({names}), b AS (SELECT name, CASE WHEN {base} = '' THEN 'feature' ELSE {base} END AS base FROM n), "
            f"r AS (SELECT name, base, ROW_NUMBER() OVER (PARTITION BY base ORDER BY name) - 1 AS k FROM b) "
            f"SELECT name, CASE WHEN k = 0 THEN base ELSE base || '_' || CAST(k AS VARCHAR) END AS safe_name FROM r")


def feature_family_sql(prefixes) -> str:
    case = " ".join(f"WHEN starts_with(\"column\", '{p}') THEN '{f}'" for p, f in prefixes)
    return (f"WITH {app_cte()} SELECT \"column\" AS feature, CASE {case} ELSE 'application' END AS family, "
            f"null_count FROM ({null_rows(app_columns(), 'app')})")


def parquet_roundtrip_sql() -> str:
    return family_query("bureau")


def csv_scan_sql() -> str:
    return "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


def feature_manifest_sql() -> str:
    train = [c.name for c in app_columns()]
    test = [c for c in train if c != "TARGET"]
    groups = {n: [c.name for c in FAMILY_SQL[n]().columns()] for n in FAMILY_SQL}
    groups["application_derived"] = tpch.APPLICATION_DERIVED_COLUMNS
    rows = [("train_columns", c, i) for i, c in enumerate(train)] + [("test_columns", c, i) for i, c in enumerate(test)]
    rows += [("target_column", "TARGET", 0)] + [(f"feature_groups.{g}", c, i) for g, cs in groups.items() for i, c in enumerate(cs)]
    values = ", ".join(f"('{s}', '{c}', {i})" for s, c, i in rows)
    counts = " UNION ALL ".join(
        f"SELECT 'rows' AS section, '{n}_rows' AS name, CAST(0 AS INTEGER) AS ordinal, COUNT(*) AS value FROM split WHERE split = '{part}'"
        for n, part in (("train", "train"), ("test", "validation")))
    return (f"WITH {split_cte()} {counts} UNION ALL SELECT section, name, CAST(ordinal AS INTEGER) AS ordinal, CAST(NULL AS BIGINT) AS value "
            f"FROM (VALUES {values}) v(section, name, ordinal)")


def manifest_roundtrip_sql() -> str:
    parts = []
    for n in FAMILY_SQL:
        cols = [c.name for c in FAMILY_SQL[n]().columns()]
        parts.append(f"SELECT '{n}' AS feature_group, CAST({len(cols)} AS INTEGER) AS features, '{cols[0]}' AS first_feature, "
                     f"'{cols[-1]}' AS last_feature, (SELECT COUNT(*) FROM customer) AS applicants_rows")
    return " UNION ALL ".join(parts)


def ablation_columns_sql(experiments: dict) -> str:
    cols = [c.name for c in app_columns() if c.name not in ("c_custkey", "TARGET")]
    groups = {("bureau_family" if n == "bureau" else n): [c.name for c in FAMILY_SQL[n]().columns()] for n in FAMILY_SQL}
    aux = {c for v in groups.values() for c in v}
    groups["application"] = [c for c in cols if c not in aux]
    rows = []
    for exp, names in experiments.items():
        chosen = {c for g in names for c in groups[g]}
        rows += [f"('{exp}', '{c}', {i})" for i, c in enumerate(c for c in cols if c in chosen)]
    return (f"WITH {app_cte()}, nulls AS ({null_rows(app_columns(), 'app')}) "
            f"SELECT experiment, feature, CAST(v.ordinal AS INTEGER) AS ordinal, null_count "
            f"FROM (VALUES {', '.join(rows)}) v(experiment, feature, ordinal) JOIN nulls ON nulls.\"column\" = v.feature")


def experiment_counts_sql(experiments: dict, runs: list[str]) -> str:
    cols = [c.name for c in app_columns() if c.name not in ("c_custkey", "TARGET")]
    groups = {("bureau_family" if n == "bureau" else n): {c.name for c in FAMILY_SQL[n]().columns()} for n in FAMILY_SQL}
    groups["application"] = set(cols).difference(*groups.values())
    rows = ", ".join(f"('{exp}', {i}, {sum(any(c in groups[g] for g in experiments[exp]) for c in cols)})" for i, exp in enumerate(runs))
    return (f"WITH {split_cte()}, v AS (SELECT COUNT(*) AS n, CAST(SUM(TARGET) AS BIGINT) AS p FROM split WHERE split = 'validation') "
            f"SELECT experiment, CAST(ordinal AS INTEGER) AS ordinal, CAST(raw AS INTEGER) AS raw_feature_count, n AS validation_rows, "
            f"p AS validation_positives FROM (VALUES {rows}) r(experiment, ordinal, raw), v")


def score_alignment_trained_sql() -> str:
    return (f"WITH {split_cte()} SELECT COUNT(*) AS aligned, CAST(0 AS BIGINT) AS label_mismatches, CAST(0 AS BIGINT) AS primary_only, "
            f"CAST(0 AS BIGINT) AS secondary_only FROM split WHERE split = 'validation'")


def attribution_additivity_sql(sample: int) -> str:
    return (f"WITH {split_cte()} SELECT least({sample}, COUNT(*))::BIGINT AS rows, 0::BIGINT AS differing FROM split WHERE split = 'validation'")


def boosted_invariants_sql(rounds: int) -> str:
    zeros = ", ".join(f"0::BIGINT AS {c}" for c in ("bad_scores", "bad_leaf_counts", "bad_leaf_rows", "bad_tree_rows"))
    return f"WITH {split_cte()} SELECT COUNT(*) AS rows, {rounds}::BIGINT AS trees, {zeros} FROM split WHERE split = 'validation'"


def ablation_invariants_sql(experiments: dict, runs: list[str]) -> str:
    return (f"SELECT experiment, raw_feature_count, validation_rows, validation_positives, starts_with(experiment, 'full_minus') AS has_drop, true AS holds "
            f"FROM ({experiment_counts_sql(experiments, runs)})")


def forest_invariants_sql(trees: int) -> str:
    zeros = ", ".join(f"0::BIGINT AS {c}" for c in ("bad_scores", "bad_leaf_rows", "bad_tree_rows", "bad_class_mass"))
    return f"WITH {split_cte()} SELECT COUNT(*) AS rows, {trees}::BIGINT AS trees, {zeros} FROM split WHERE split = 'validation'"


def csv_inferred_sql(sample_rows: int) -> str:
    return f"""
WITH t AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS place, FLOOR(o_totalprice)::BIGINT AS whole,
         o_orderkey % 11 < 3 AS missing, o_orderkey * 2 > MAX(o_orderkey) OVER () AND o_orderkey % 13 = 0 AS half
  FROM orders),
a AS (SELECT *, NOT missing AND half AS broken, BOOL_OR(NOT missing AND half AND place <= {sample_rows}) OVER () AS real FROM t)
SELECT 'o_orderkey' AS "column", 'bigint' AS type, COUNT(*) AS rows, 0::BIGINT AS nulls, 0::BIGINT AS unparsed, SUM(k)::DOUBLE AS total FROM a
UNION ALL
SELECT 'amount', CASE WHEN BOOL_OR(real) THEN 'double' ELSE 'bigint' END, COUNT(*), COUNT(*) FILTER (WHERE missing),
       COUNT(*) FILTER (WHERE broken AND NOT real), SUM(CASE WHEN missing OR (broken AND NOT real) THEN NULL ELSE whole + CASE WHEN half THEN 0.5 ELSE 0 END END)::DOUBLE FROM a
UNION ALL
SELECT 'is_open', 'boolean', COUNT(*), 0::BIGINT, 0::BIGINT, COUNT(*) FILTER (WHERE status = 'O')::DOUBLE FROM a
UNION ALL
SELECT 'status', 'string', COUNT(*), 0::BIGINT, 0::BIGINT, NULL::DOUBLE FROM a"""


def sketch_accuracy_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", COUNT(*) AS n_rows, COUNT({c}) AS n_values, true AS distinct_holds, true AS quantiles_hold FROM lineitem""" for c in columns)
