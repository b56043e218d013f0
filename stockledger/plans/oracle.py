"""DuckDB SQL for every catalog query, from the semantic rules rather than the Spark plans.

The stock side is a dense calendar: every (root, store) key has one row for
each day of the period with its balance, and everything about stock is read
off it. A ledger day is a calendar day with movements, an interval is a run of
days up to the next ledger day, a daily row is a calendar day with positive
balance. The money side is one union of signed facts (sales and inbound rows,
each with its product's flags), summed per entity and year.

The checks' counts come from recomputing the figures and comparing them with
published tables that a fixed rule has damaged (``DAMAGE``), so a check that
never fires would differ.

Sums of BIGINT are cast back to BIGINT and money goes to DOUBLE after an exact
DECIMAL sum, to give Spark's types.
"""

from __future__ import annotations

from ..config import ADAPTER_PERIOD, Period
from ..schema import MOVEMENTS, OUTPUT_SCHEMAS, PRODUCTS, SALES

# The mapping of FIXTURES.md §4 onto the retail tables.
TABLES = """
products AS (
  SELECT CAST(p_partkey AS BIGINT) AS ProductId,
         CASE WHEN p_partkey % 53 <> 0 THEN CAST(FLOOR(p_partkey / 20) AS BIGINT) END AS ProductRootCode,
         CASE WHEN p_partkey % 59 <> 5 THEN p_type END AS Family,
         CASE WHEN p_partkey % 41 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(25,15)) END AS RetailPrice,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.4123456789 AS DECIMAL(11,10)) AS DECIMAL(25,15)) AS SupplierPrice
  FROM part WHERE {products}),
movements AS (
  SELECT CASE WHEN l_partkey % 97 = 0 AND l_suppkey % 10 = 3 THEN CAST(99 AS BIGINT) ELSE l_suppkey % 10 END AS StoreId,
         l_partkey AS ProductId, CAST(l_shipdate AS DATE) AS Date,
         CAST(l_quantity AS BIGINT) * (CASE l_returnflag WHEN 'R' THEN -2 ELSE 1 END) AS Quantity
  FROM lineitem),
sales AS (
  SELECT l_suppkey % 10 AS StoreId, l_partkey AS ProductId, CAST(o_orderdate AS DATE) AS Date, CAST(l_quantity AS BIGINT) AS Quantity
  FROM orders, lineitem WHERE o_orderkey = l_orderkey AND {sales})
"""

#: Rows that a holed variant of the tables lacks (tests of S1, S14, S15 and S19).
HOLED = {"products": "p_partkey % 97 <> 0", "sales": "l_returnflag = 'R' AND NOT (l_suppkey % 10 = 7 AND YEAR(o_orderdate) = 1999)"}
WHOLE = {"products": "TRUE", "sales": "TRUE"}


def _base(p: Period, holes: dict[str, str]) -> str:
    years = "[" + ", ".join(str(int(y)) for y in p.years) + "]"
    o, c = p.opening.isoformat(), p.closing.isoformat()
    return TABLES.format(**holes) + f""",
moved AS (
  SELECT StoreId, ProductId, Date, Quantity, ProductRootCode FROM movements JOIN products USING (ProductId)
  WHERE ProductRootCode IS NOT NULL),
day_net AS (
  SELECT ProductRootCode, StoreId, Date, CAST(SUM(Quantity) AS BIGINT) AS Quantity FROM moved WHERE Date IS NOT NULL GROUP BY ALL),
in_period AS (
  SELECT ProductRootCode, StoreId, GREATEST(Date, DATE '{o}') AS day, SUM(Quantity) AS q FROM day_net WHERE Date <= DATE '{c}' GROUP BY ALL),
calendar AS (
  SELECT k.ProductRootCode, k.StoreId, CAST(d.day AS DATE) AS day
  FROM (SELECT DISTINCT ProductRootCode, StoreId FROM in_period) k, (SELECT UNNEST(GENERATE_SERIES(TIMESTAMP '{o}', TIMESTAMP '{c}', INTERVAL 1 DAY)) AS day) d),
held AS (
  SELECT ProductRootCode, StoreId, day, q IS NOT NULL AS is_ledger_day,
         CAST(SUM(COALESCE(q, 0)) OVER (PARTITION BY ProductRootCode, StoreId ORDER BY day) AS BIGINT) AS balance,
         COUNT(q) OVER (PARTITION BY ProductRootCode, StoreId ORDER BY day) AS stretch
  FROM calendar LEFT JOIN in_period USING (ProductRootCode, StoreId, day)),
intervals AS (
  SELECT ProductRootCode, StoreId, MIN(day) AS StartDate, MAX(day) AS EndDate, MIN(balance) AS Stock
  FROM held WHERE balance > 0 GROUP BY ProductRootCode, StoreId, stretch),
daily AS (SELECT ProductRootCode, StoreId, day AS Date, balance AS Stock FROM held WHERE balance > 0),
fact AS (
  SELECT StoreId, ProductId, YEAR(Date) AS y, Quantity AS sold, NULL AS received FROM sales
  UNION ALL SELECT StoreId, ProductId, YEAR(Date), NULL, Quantity FROM movements WHERE Quantity > 0),
valued AS (
  SELECT f.StoreId, p.Family, CAST(f.y AS INTEGER) AS Anio, p.ProductId IS NOT NULL AS known, p.RetailPrice IS NOT NULL AS priced, f.sold, f.received,
         CAST(f.sold AS DECIMAL(12,0)) * p.RetailPrice AS revenue, CAST(f.received AS DECIMAL(12,0)) * p.SupplierPrice AS cost
  FROM fact f LEFT JOIN products p USING (ProductId) WHERE f.y IN (SELECT UNNEST({years}))),
by_store AS (SELECT StoreId, Anio, {_SUMS} FROM valued GROUP BY ALL),
by_family AS (SELECT Family, Anio, {_SUMS} FROM valued WHERE known GROUP BY ALL),
stores AS (SELECT StoreId FROM movements UNION SELECT StoreId FROM sales),
families AS (SELECT Family FROM products GROUP BY Family),
store_stock AS (
  SELECT StoreId, CAST(YEAR(Date) AS INTEGER) AS Anio, CAST(SUM(Stock) AS BIGINT) AS days FROM daily WHERE YEAR(Date) IN (SELECT UNNEST({years})) GROUP BY ALL),
root_stock AS (
  SELECT ProductRootCode, CAST(YEAR(Date) AS INTEGER) AS Anio, SUM(Stock) AS days FROM daily WHERE YEAR(Date) IN (SELECT UNNEST({years})) GROUP BY ALL),
root_family AS (SELECT ProductRootCode, Family, COUNT(*) AS members FROM products GROUP BY ALL),
family_stock AS (
  SELECT Family, Anio, CAST(SUM(days * members) AS BIGINT) AS days, CAST(SUM(days) AS BIGINT) AS days_once
  FROM root_stock JOIN root_family USING (ProductRootCode) GROUP BY ALL),
store_year AS (
  SELECT e.StoreId, e.Anio, {_FIGURES}
  FROM (SELECT StoreId, CAST(UNNEST({years}) AS INTEGER) AS Anio FROM stores) e
  LEFT JOIN by_store USING (StoreId, Anio) LEFT JOIN store_stock USING (StoreId, Anio)),
family_year AS (
  SELECT e.Family, e.Anio, {_FIGURES}
  FROM (SELECT Family, CAST(UNNEST({years}) AS INTEGER) AS Anio FROM families) e
  LEFT JOIN by_family USING (Family, Anio) LEFT JOIN family_stock USING (Family, Anio))
"""


_SUMS = """SUM(revenue) AS revenue, SUM(cost) FILTER (priced) AS cost, SUM(cost) FILTER (NOT priced) AS unpriced_cost,
         CAST(SUM(sold) AS BIGINT) AS units, COUNT(sold) AS n_sold, COUNT(sold) FILTER (priced) AS n_valued,
         COUNT(received) FILTER (priced) AS n_received"""
_FIGURES = """COALESCE(revenue, 0) - COALESCE(cost, 0) AS benefit, COALESCE(unpriced_cost, 0) AS unpriced,
         CASE WHEN COALESCE(days, 0) = 0 THEN CAST(COALESCE(units, 0) AS DOUBLE) ELSE COALESCE(units, 0) / (days / 365) END AS rotation"""


def _count(name: str, bad: str, source: str, alias: str = "check") -> str:
    return f'SELECT \'{name}\' AS "{alias}", COUNT(*) AS n_checked, COUNT(*) FILTER ({bad}) AS n_violations FROM {source}'


#: Damage done to published tables before they are checked; the catalog does the same in Spark.
_FAR = "ABS(published - recomputed) > 1e-9 * GREATEST(1, ABS(published), ABS(recomputed))"


def _judged(level: str, figure: str) -> str:
    """Published figures of a level, damaged where the rule says, beside recomputed ones."""
    entity, table = ("StoreId", "store_year") if level == "store" else ("Family", "family_year")
    rule = "StoreId % 5 = 0" if level == "store" else "LENGTH(Family) % 5 = 0"
    return f"""(SELECT {entity}, Anio, CAST({figure} AS DOUBLE) + (CASE WHEN {rule} AND Anio % 2 = 0 THEN 1 ELSE 0 END) AS published,
  CAST({figure} AS DOUBLE) AS recomputed FROM {table})"""


_AS_OF = """(SELECT i.*, (SELECT SUM(d.Quantity) FROM day_net d
    WHERE d.ProductRootCode = i.ProductRootCode AND d.StoreId = i.StoreId AND d.Date <= i.StartDate) AS true_stock FROM {0} i)"""
_SHIFTED = "(SELECT * REPLACE (Stock + (CASE WHEN StoreId % 5 = 0 THEN 1 ELSE 0 END) AS Stock) FROM intervals)"
_EMPTIED = "(SELECT * REPLACE (CASE WHEN StoreId % 5 = 0 THEN 0 ELSE Stock END AS Stock) FROM intervals)"
#: Day 15 of stores divisible by 5 is lost, day 20 of the stores after them doubled, day 25 of the next has one unit more.
_DAMAGED_DAYS = """(SELECT ProductRootCode, StoreId, Date, Stock + (CASE WHEN StoreId % 5 = 2 AND DAY(Date) = 25 THEN 1 ELSE 0 END) AS Stock
  FROM daily, (SELECT UNNEST([1, 2]) AS copy)
  WHERE NOT (StoreId % 5 = 0 AND DAY(Date) = 15) AND (copy = 1 OR (StoreId % 5 = 1 AND DAY(Date) = 20)))"""


def _days_check(days: str) -> str:
    """Intervals whose days are not all there, wrong or stray days, and extra copies."""
    return f"""
SELECT 'daily_expansion' AS "check", (SELECT COUNT(*) FROM intervals) AS n_checked,
  CAST((SELECT COUNT(*) FROM intervals i LEFT JOIN (
      SELECT h.ProductRootCode, h.StoreId, h.stretch, MIN(h.day) AS StartDate, COUNT(*) - COUNT(x.Stock) AS missing
      FROM held h LEFT JOIN (SELECT DISTINCT * FROM {days}) x ON x.ProductRootCode = h.ProductRootCode AND x.StoreId = h.StoreId AND x.Date = h.day AND x.Stock = h.balance
      WHERE h.balance > 0 GROUP BY ALL) m USING (ProductRootCode, StoreId, StartDate) WHERE m.missing > 0)
   + (SELECT COUNT(*) FROM {days} x ANTI JOIN daily t USING (ProductRootCode, StoreId, Date, Stock))
   + (SELECT COUNT(*) - COUNT(DISTINCT (ProductRootCode, StoreId, Date)) FROM {days} x SEMI JOIN daily t USING (ProductRootCode, StoreId, Date, Stock)) AS BIGINT) AS n_violations"""


def _bad_days(days: str) -> str:
    key = "x.ProductRootCode = t.ProductRootCode AND x.StoreId = t.StoreId AND x.Date = t.Date"
    none, zero = "CAST(NULL AS BIGINT)", "CAST(0 AS BIGINT) AS Extra"
    return f"""
SELECT 'missing' AS Problem, ProductRootCode, StoreId, Date, {none} AS Stock, Stock AS Expected, {zero} FROM daily t ANTI JOIN {days} x ON {key}
UNION ALL SELECT 'wrong_stock', x.ProductRootCode, x.StoreId, x.Date, x.Stock, t.Stock, {zero} FROM (SELECT DISTINCT * FROM {days}) x JOIN daily t ON {key} WHERE x.Stock <> t.Stock
UNION ALL SELECT 'stray', ProductRootCode, StoreId, Date, Stock, {none}, {zero} FROM (SELECT DISTINCT * FROM {days}) x ANTI JOIN daily t ON {key}
UNION ALL SELECT 'repeated', ProductRootCode, StoreId, Date, Stock, {none}, COUNT(*) - 1 FROM {days} GROUP BY ALL HAVING COUNT(*) > 1"""


def _print(table: str, columns: list[str], doubles: tuple[str, ...] = ()) -> str:
    """Rows and fingerprint of a relation: the sum of the first 60 bits of md5 over every value's length and text."""
    text = [
        f"(FLOOR({c})::BIGINT)::VARCHAR || '+' || (FLOOR(({c} - FLOOR({c})) * 1000000 + 0.5)::BIGINT)::VARCHAR" if c in doubles else f"CAST({c} AS VARCHAR)" for c in columns
    ]
    row = " || ".join(f"COALESCE(LENGTH({t}) || ':' || {t}, '-')" for t in text)
    return f"COUNT(*) AS rows, CAST(COALESCE(SUM(('0x' || SUBSTR(MD5({row}), 1, 15))::BIGINT), 0) AS VARCHAR) AS fingerprint FROM {table}"


def _published(published: dict[str, str]) -> str:
    """Rows and fingerprints of the eight published tables."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS output, *, TRUE AS listed FROM (SELECT {_print('(' + published[name] + ')', schema.names, tuple(n for n in schema.names if schema[n].dataType.typeName() == 'double'))})"
        for name, schema in OUTPUT_SCHEMAS.items()
    )


def _finals(p: Period) -> dict[str, str]:
    first, last = int(min(p.years)), int(max(p.years))
    label = "CAST(Anio AS VARCHAR) || ' - ' || {0}"
    nulls = [
        (f"{t}_{c.lower()}_not_null", f"{c} IS NULL", t) for t in ("movements", "sales") for c in ("Date", "StoreId", "ProductId", "Quantity")
    ]
    out = {
        "attach_root": "FROM moved",
        "net_movements": "FROM day_net",
        "running_stock": "SELECT *, CAST(SUM(Quantity) OVER (PARTITION BY ProductRootCode, StoreId ORDER BY Date) AS BIGINT) AS Stock FROM day_net",
        "opening_collapse": "SELECT ProductRootCode, StoreId, day AS Date, balance AS Stock FROM held WHERE is_ledger_day",
        "interval_stock": "FROM intervals",
        "daily_stock": "FROM daily",
        "stock_as_of": "SELECT ProductRootCode, StoreId, StartDate AS AsOf, CAST(true_stock AS BIGINT) AS Balance FROM " + _AS_OF.format("intervals"),
        "interval_band": """SELECT *, CAST(EndDate - StartDate AS INTEGER) AS DaySpan FROM intervals WHERE Stock >= {lo} AND Stock <= {hi}
ORDER BY Stock, ProductRootCode, StoreId, StartDate LIMIT 3""",
        "latest_interval": "SELECT ProductRootCode, StoreId, MAX(StartDate) AS StartDate FROM intervals GROUP BY ALL",
        "store_universe": "FROM stores",
        "family_universe": "FROM families",
        "store_year_spine": "SELECT StoreId, Anio FROM store_year",
        "unpriced_products": """SELECT ProductId, ProductRootCode, Family, CAST(NULL AS DOUBLE) AS RetailPrice, CAST(SupplierPrice AS DOUBLE) AS SupplierPrice
FROM products WHERE RetailPrice IS NULL""",
        "unpriced_by_family": "SELECT Family, COUNT(*) AS Cantidad FROM products WHERE RetailPrice IS NULL GROUP BY Family",
        "unpriced_total": "SELECT CAST(SUM(unpriced) AS DOUBLE) AS TotalCosto FROM store_year",
        "top_store_benefits": f"SELECT StoreId, Anio, CAST(benefit AS DOUBLE) AS Beneficio FROM store_year WHERE Anio = {last} ORDER BY benefit DESC, StoreId NULLS LAST LIMIT 3",
        "top_family_benefits": f"SELECT Family, Anio, CAST(benefit AS DOUBLE) AS Beneficio FROM family_year WHERE Anio = {first} ORDER BY benefit DESC, Family NULLS LAST LIMIT 3",
        "top_store_rotation": f"SELECT StoreId, Anio, rotation AS Rotacion FROM store_year WHERE Anio = {first} ORDER BY rotation DESC, StoreId NULLS LAST LIMIT 3",
        "top_family_rotation": f"SELECT Family, Anio, rotation AS Rotacion FROM family_year WHERE Anio = {last} ORDER BY rotation DESC, Family NULLS LAST LIMIT 3",
        "store_cost_label": f"SELECT {label.format('CAST(StoreId AS VARCHAR)')} AS Anio_StoreId, CAST(unpriced AS DOUBLE) AS TotalCosto FROM store_year",
        "store_benefit_label": f"SELECT {label.format('CAST(StoreId AS VARCHAR)')} AS Anio_StoreId, CAST(benefit - unpriced AS DOUBLE) AS TotalBeneficio FROM store_year WHERE StoreId IS NOT NULL",
        "family_benefit_label": f"SELECT {label.format('Family')} AS Anio_Family, CASE WHEN Family IS NOT NULL THEN CAST(benefit - unpriced AS DOUBLE) END AS TotalBeneficio FROM family_year",
        "family_mean_stock_dedup": "SELECT Family, Anio, days_once AS StockDays, days_once / 365 AS StockMedio FROM family_stock",
        "check_positive": _count("positive_stock", "Stock <= 0", "intervals"),
        "check_interval_balance": _count("interval_balance", "true_stock IS DISTINCT FROM Stock", _AS_OF.format("intervals")),
        "check_daily_expansion": _days_check("daily"),
        "check_positive_damaged": _count("positive_stock", "Stock <= 0", _EMPTIED),
        "check_interval_balance_damaged": _count("interval_balance", "true_stock IS DISTINCT FROM Stock", _AS_OF.format(_SHIFTED)),
        "check_daily_expansion_damaged": _days_check(_DAMAGED_DAYS),
        "daily_violations": _bad_days(_DAMAGED_DAYS),
        "kpi_facts": """SELECT known AS Known, StoreId, NULL AS Family, Anio, 'StoreId' AS Level, CAST(SUM(sold) AS BIGINT) AS Units,
  CAST(SUM(revenue) AS DOUBLE) AS SalesValue, CAST(NULL AS DOUBLE) AS InboundCost FROM valued WHERE sold IS NOT NULL GROUP BY ALL
UNION ALL SELECT known, NULL, Family, Anio, 'Family', CAST(SUM(sold) AS BIGINT), CAST(SUM(revenue) AS DOUBLE), NULL FROM valued WHERE sold IS NOT NULL GROUP BY ALL
UNION ALL SELECT known, StoreId, NULL, Anio, 'StoreId', NULL, NULL, CAST(SUM(cost) FILTER (priced) AS DOUBLE) FROM valued WHERE received IS NOT NULL GROUP BY ALL
UNION ALL SELECT known, NULL, Family, Anio, 'Family', NULL, NULL, CAST(SUM(cost) FILTER (priced) AS DOUBLE) FROM valued WHERE received IS NOT NULL GROUP BY ALL""",
        "positive_violations": f"FROM {_EMPTIED} WHERE Stock <= 0",
        "balance_violations": f"SELECT ProductRootCode, StoreId, StartDate AS AsOf, Stock, CAST(true_stock AS BIGINT) AS Balance FROM {_AS_OF.format(_SHIFTED)} WHERE true_stock IS DISTINCT FROM Stock",
        "contract_violations": "SELECT 'product_root_not_null' AS rule, ProductId, CAST(NULL AS BIGINT) AS StoreId, CAST(NULL AS DATE) AS Date FROM products WHERE ProductRootCode IS NULL"
        " UNION ALL SELECT 'unknown_product_movements', ProductId, StoreId, Date FROM movements ANTI JOIN products USING (ProductId)",
        "check_contract": "\nUNION ALL ".join(
            [
                _count("unique_product_id", "n > 1", "(SELECT ROW_NUMBER() OVER (PARTITION BY ProductId) AS n FROM products)"),
                _count("product_root_not_null", "ProductRootCode IS NULL", "products"),
                _count("price_digits_kept", "FALSE", "products"),
                _count("unknown_product_movements", "p.ProductId IS NULL", "movements m LEFT JOIN products p USING (ProductId)"),
                *(_count(*rule) for rule in nulls),
            ]
        ),
    }
    for level, entity in (("store", "StoreId"), ("family", "Family")):
        row, whole = f"SELECT {entity}, Anio, ", f"{level}_year"
        known = f" WHERE {entity} IS NOT NULL" if level == "store" else ""
        v2 = "benefit - unpriced" if level == "store" else "CASE WHEN Family IS NOT NULL THEN benefit - unpriced END"
        check = entity.lower()
        out |= {
            f"{level}_sales_value": f"{row}CAST(revenue AS DOUBLE) AS TotalVentas FROM by_{level} WHERE n_valued > 0",
            f"{level}_inbound_cost": f"{row}CAST(cost AS DOUBLE) AS TotalCostos FROM by_{level} WHERE n_received > 0",
            f"{level}_units_sold": f"{row}units AS UnidadesVendidas FROM by_{level} WHERE n_sold > 0",
            f"{level}_mean_stock": f"{row}days AS StockDays, days / 365 AS StockMedio FROM {level}_stock",
            f"{level}_benefits": f"{row}CAST(benefit AS DOUBLE) AS Beneficio FROM {whole}",
            f"{level}_rotation": f"{row}rotation AS Rotacion FROM {whole}",
            f"{level}_cost_unpriced": f"{row}CAST(unpriced AS DOUBLE) AS TotalCosto FROM {whole}",
            f"{level}_benefits_v2": f"{row}CAST({v2} AS DOUBLE) AS TotalBeneficio FROM {whole}{known}",
        }
        for name, figure in (("benefit", "benefit"), ("rotation", "rotation")):
            judged = _judged(level, figure)
            clean = f"(SELECT CAST({figure} AS DOUBLE) AS published, CAST({figure} AS DOUBLE) AS recomputed FROM {whole})"
            out |= {
                f"check_{level}_{name}": _count(f"{check}_{name}", _FAR, clean),
                f"check_{level}_{name}_damaged": _count(f"{check}_{name}", _FAR, judged),
                f"{level}_{name}_violations": f"SELECT {entity}, Anio, published AS Published, recomputed AS Recomputed FROM {judged} WHERE {_FAR}",
            }
    whole = {name: sql.removeprefix("FROM ") for name, sql in out.items() if sql in ("FROM intervals", "FROM daily")}
    out["published_roundtrip"] = _published({name: f"SELECT * FROM {whole[name]}" if name in whole else out[name] for name in OUTPUT_SCHEMAS})
    out["inputs_roundtrip"] = "\nUNION ALL ".join(
        f"SELECT '{name}' AS input, {_print(name, schema.names)}" for name, schema in (("products", PRODUCTS), ("sales", SALES), ("movements", MOVEMENTS))
    )
    out["files_store_rotation"] = out["store_rotation"]
    return out


def oracle_queries(period: Period = ADAPTER_PERIOD, band: tuple[int, int] = (0, 0), holes: dict[str, str] = WHOLE) -> dict[str, str]:
    base = _base(period, holes)
    finals = {k: v.replace("{lo}", str(band[0])).replace("{hi}", str(band[1])) for k, v in _finals(period).items()}
    return {name: f"WITH {base}\n{final}" for name, final in finals.items()}
