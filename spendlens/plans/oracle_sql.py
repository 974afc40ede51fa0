"""Independent SQL formulation of every registered query (runs on DuckDB).

Nothing here is imported or generated from the Spark side: run parameters, share rates, aliases
and the fixtures' multipliers are stated again as small VALUES tables and literals, and rules are
joins with those tables. Agreement between the two is the correctness check.

Sums are exact decimals; results are presented as DOUBLE.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# The fixture run, as SQL literals.
# ---------------------------------------------------------------------------------------
START = "DATE '1995-04-01'"
EVER, NEVER = "DATE '0001-01-01'", "DATE '9999-12-31'"
CUTOVER = "DATE '1998-01-01'"
#: last MMP day, run date (SKAN ends before it), run date minus 366 days
RUN = ("DATE '2001-06-29'", "DATE '2001-07-02'", "DATE '2000-07-01'")
EARLIER_RUN = ("DATE '2001-03-29'", "DATE '2001-04-02'", "DATE '2000-04-01'")

#: application: share of IAP, of ads, of subscriptions at the full and at the reduced store fee
SHARES = """(VALUES
  ('ECONOMY',  0.616, 0.880, 0.616, 0.748),
  ('STANDARD', 0.700, 1.000, 0.700, 0.850),
  ('PROMO',    0.525, 0.750, 0.525, 0.638),
  ('SMALL',    0.546, 0.780, 0.700, 0.850),
  ('MEDIUM',   0.700, 1.000, 0.700, 0.850))"""
PAID = "(VALUES ('MM'), ('MK'), ('MC'))"
ALIASES = "(VALUES ('SKANUAC', 'ADWORDS'), ('SKANFB', 'SGNFB'))"

DAYS = ("001", "003", "007", "014", "028")
RETENTION = {"001": "0.60", "003": "0.40", "007": "0.25"}
GROSS = {
    "REVS": dict(zip(DAYS, ("0.50", "0.90", "1.40", "1.90", "2.60"))),
    "AD_REVS": dict(zip(DAYS, ("0.20", "0.35", "0.55", "0.80", "1.10"))),
    "SUBSCRIPTIONS_REVS": dict(zip(DAYS, ("0.10", "0.25", "0.45", "0.70", "0.95"))),
}

RETAINED = [f"RETENTION_DAY_{d}_QTY" for d in RETENTION]
REVENUES = [f"{k}_REVS_DAY_{d}_AMT" for d in DAYS for k in ("IAP", "AD", "SUB")]
METRICS = ["SPEND", "INSTALL_NUM", *RETAINED, *REVENUES, "IAP_LTV", "AD_LTV", "SUB_LTV", "TOTAL_LTV"]
OUT = ["INSTALL" if m == "INSTALL_NUM" else m for m in METRICS]
COUNTS = ["INSTALL", *RETAINED]

GAME = ["APPLICATION_FAMILY_NAME", "MARKET_CD", "SOURCE"]
DAY_KEYS = ["APPLICATION_FAMILY_NAME", "MARKET_CD", "CALENDAR_DT"]
PLACE = ["APPLICATION_FAMILY_NAME", "MARKET_CD", "CHANNEL_NAME", "PROMOTION_NAME", "CALENDAR_DT"]
CAMPAIGN = [*PLACE[:2], "USER_SOURCE_TYPE_CD", *PLACE[2:]]
FULL = [*GAME, "USER_SOURCE_TYPE_CD", *PLACE[2:]]
CHANNEL = [k for k in FULL if k != "PROMOTION_NAME"]


def _names(*parts) -> str:
    return ", ".join(x for p in parts for x in ([p] if isinstance(p, str) else p))


def _exact(expr: str, name: str) -> str:
    return f"CAST({expr} AS DECIMAL(36,12)) AS {name}"


def _double(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def _same(a: str, b: str, keys: list[str]) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


# ---------------------------------------------------------------------------------------
# Fixtures
# ---------------------------------------------------------------------------------------
def _fixtures() -> str:
    quantities = [f"CAST(QTY * {m} AS DECIMAL(18,2)) AS RETENTION_DAY_{d}_QTY" for d, m in RETENTION.items()]
    quantities += [f"CAST(QTY * {m} AS DECIMAL(18,2)) AS {k}_DAY_{d}_AMT" for k, by in GROSS.items() for d, m in by.items()]
    return f"""
source_of (o_orderpriority, src) AS (VALUES ('1-URGENT', 'MM'), ('2-HIGH', 'MK'), ('3-MEDIUM', 'MC'), ('4-NOT SPECIFIED', 'US')),
channel_of (c_mktsegment, chan) AS (VALUES ('AUTOMOBILE', 'SKANUAC'), ('BUILDING', 'SKANFB'), ('FURNITURE', 'X_UNTRUSTED'),
  ('HOUSEHOLD', 'ADWORDS')),
dims AS (
  SELECT p_type AS APPLICATION_FAMILY_NAME,
    CASE WHEN p_size = 50 THEN 'XX' WHEN l_linestatus = 'O' THEN 'IT' ELSE 'GO' END AS MARKET_CD,
    CASE WHEN l_suppkey % 10 <> 3 THEN coalesce(src, 'OT') END AS USER_SOURCE_TYPE_CD,
    coalesce(chan, 'UNITY') AS CHANNEL_NAME,
    'P' || CAST(p_size % 3 AS VARCHAR(4)) AS PROMOTION_NAME,
    CAST(date_trunc('quarter', l_shipdate) AS DATE) AS EVENT_DT,
    CASE l_returnflag WHEN 'R' THEN 'Retargeting' ELSE 'New Installs' END AS MVP_CAMPAIGN_TYPE,
    CAST(l_quantity AS DECIMAL(18,0)) AS QTY, CAST(l_extendedprice AS DECIMAL(18,2)) AS PRICE,
    CAST(l_discount AS DECIMAL(4,2)) AS DISCOUNT, l_linenumber, l_linestatus, o_custkey, o_orderstatus
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
  LEFT JOIN source_of USING (o_orderpriority) LEFT JOIN channel_of USING (c_mktsegment)
),
promo_fact AS (
  SELECT APPLICATION_FAMILY_NAME, MARKET_CD, MVP_CAMPAIGN_TYPE, USER_SOURCE_TYPE_CD, CHANNEL_NAME, PROMOTION_NAME,
    EVENT_DT AS CALENDAR_DT, CAST(PRICE * DISCOUNT AS DECIMAL(18,4)) AS EXPENSE_AMT, CAST(QTY AS DECIMAL(18,2)) AS USER_QTY,
    PRICE AS LTV_365_LASTEST_VAL, CAST(QTY * 7.25 AS DECIMAL(18,2)) AS AD_LTV_365_LASTEST_VAL,
    {_names(quantities)}
  FROM dims
),
install AS (
  SELECT APPLICATION_FAMILY_NAME, MARKET_CD, USER_SOURCE_TYPE_CD, CHANNEL_NAME, PROMOTION_NAME, EVENT_DT AS INSTALL_DT,
    o_orderstatus AS APPLICATION_CD, o_custkey AS ACCOUNT_ID, o_custkey % 7 AS USER_ID
  FROM dims WHERE l_linenumber = 1
),
individual_ltv AS (
  SELECT o_custkey AS ACCOUNT_ID, o_custkey % 7 AS USER_ID, o_orderstatus AS APPLICATION_CD,
    CAST(date_trunc('quarter', o_orderdate) AS DATE) AS PROJECTION_DT,
    {_names([f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) * {m} AS DECIMAL(18,4)) AS {k}_PROJECTEDREVENUE_365"
             for k, m in (("IAP", "0.02"), ("AD", "0.03"), ("SUB", "0.01"))])}
  FROM orders
),
skan_ltv AS (
  SELECT APPLICATION_FAMILY_NAME, alias.name AS CHANNEL_NAME, PROMOTION_NAME AS PROMOTION_CD, EVENT_DT AS INSTALL_DT,
    CAST(QTY * 0.80 AS DECIMAL(18,2)) AS INSTALL_NUM,
    CAST(PRICE * 0.9 AS DECIMAL(18,3)) AS GROSS_IAP_LTV_365_LATEST_VAL,
    CAST(PRICE * 0.75 AS DECIMAL(18,4)) AS NET_OVERALL_LTV_365_LATEST_VAL
  FROM dims JOIN alias ON alias.raw = dims.CHANNEL_NAME
  WHERE l_linestatus = 'O' AND USER_SOURCE_TYPE_CD = 'MK'
)"""


RULES = f"""
shares (app, iap, ad, full_fee, reduced_fee) AS {SHARES},
paid (src) AS {PAID},
alias (raw, name) AS {ALIASES}"""


# ---------------------------------------------------------------------------------------
# Stages of one run (named with a prefix, so that two runs can stand side by side)
# ---------------------------------------------------------------------------------------
def _gross_iap(day: str, legacy: bool = True) -> str:
    """Gross IAP revenue of a day; SMALL's days 14 and 28 read day 1 in the published job."""
    x = f"REVS_DAY_{day}_AMT"
    return f"CASE app WHEN 'SMALL' THEN REVS_DAY_001_AMT ELSE {x} END" if legacy and day in ("014", "028") else x


def _net(day: str, legacy: bool = True) -> dict[str, str]:
    return {
        f"IAP_REVS_DAY_{day}_AMT": f"sum({_gross_iap(day, legacy)} * iap)",
        f"AD_REVS_DAY_{day}_AMT": f"sum(AD_REVS_DAY_{day}_AMT * ad)",
        f"SUB_REVS_DAY_{day}_AMT": f"coalesce(sum(SUBSCRIPTIONS_REVS_DAY_{day}_AMT * sub), 0)",
    }


def _stages(p: str = "", run: tuple[str, str, str] = RUN, legacy: bool = True, installs: str = "install") -> str:
    end, as_of, year_ago = run
    net = {"SPEND": "sum(EXPENSE_AMT)", "INSTALL_NUM": "sum(USER_QTY)"} | {m: f"sum({m})" for m in RETAINED}
    for d in DAYS:
        net |= _net(d, legacy)
    net |= {"IAP_LTV": "sum(LTV_365_LASTEST_VAL * iap)", "AD_LTV": "sum(AD_LTV_365_LASTEST_VAL * ad)"}
    skan = dict.fromkeys(METRICS[1:], "0") | {
        "INSTALL_NUM": "sum(INSTALL_NUM)",
        "IAP_LTV": "sum(GROSS_IAP_LTV_365_LATEST_VAL * iap)",
        "TOTAL_LTV": "sum(NET_OVERALL_LTV_365_LATEST_VAL)",
    }
    plus, minus = ("sum({}) FILTER (WHERE side = 'all')", "coalesce(sum({}) FILTER (WHERE side <> 'all'), 0)")
    return f"""
{p}fees (use_, market, d_from, d_to, fee) AS (VALUES
  ('revenue', 'GO', {EVER}, {CUTOVER}, 'full'), ('revenue', 'GO', {CUTOVER}, {NEVER}, 'reduced'),
  ('revenue', 'IT', {EVER}, {year_ago}, 'reduced'), ('revenue', 'IT', {year_ago}, {NEVER}, 'full'),
  ('ltv', 'GO', {EVER}, {CUTOVER}, 'full'), ('ltv', 'GO', {CUTOVER}, {NEVER}, 'reduced'),
  ('ltv', 'IT', {EVER}, {NEVER}, 'full')),
{p}sub_shares AS (
  SELECT use_, app, market, d_from, d_to, CASE fee WHEN 'full' THEN full_fee ELSE reduced_fee END AS sub
  FROM shares CROSS JOIN {p}fees
),
{p}netted AS (
  SELECT f.* EXCLUDE (CHANNEL_NAME, PROMOTION_NAME), s.app, s.iap, s.ad, r.sub,
    CASE WHEN paid.src IS NULL THEN 'ORGANIC' ELSE coalesce(alias.name, f.CHANNEL_NAME) END AS CHANNEL_NAME,
    CASE WHEN paid.src IS NULL THEN 'ORGANIC' ELSE f.PROMOTION_NAME END AS PROMOTION_NAME
  FROM promo_fact f
  JOIN shares s ON s.app = f.APPLICATION_FAMILY_NAME
  JOIN {p}sub_shares r ON r.use_ = 'revenue' AND r.app = s.app AND r.market = f.MARKET_CD
    AND f.CALENDAR_DT >= r.d_from AND f.CALENDAR_DT < r.d_to
  LEFT JOIN paid ON paid.src = f.USER_SOURCE_TYPE_CD
  LEFT JOIN alias ON alias.raw = f.CHANNEL_NAME
  WHERE f.CALENDAR_DT >= {START} AND f.CALENDAR_DT <= {end} AND f.MVP_CAMPAIGN_TYPE = 'New Installs'
    AND f.CHANNEL_NAME NOT LIKE '%UNTRUSTED%'
),
{p}fact_rollup AS (
  SELECT * FROM (
    SELECT {_names(CAMPAIGN, [_exact(x, m) for m, x in net.items()])} FROM {p}netted GROUP BY ALL
  ) g WHERE SPEND > 0 OR INSTALL_NUM > 0
),
{p}dated AS (
  SELECT *, rank() OVER (PARTITION BY ACCOUNT_ID, USER_ID, APPLICATION_CD ORDER BY PROJECTION_DT DESC) AS age
  FROM individual_ltv
  WHERE PROJECTION_DT IS NOT NULL AND ACCOUNT_ID IS NOT NULL AND USER_ID IS NOT NULL AND APPLICATION_CD IS NOT NULL
),
{p}per_user AS (
  SELECT ACCOUNT_ID, USER_ID, APPLICATION_CD, count(*) AS n, sum(SUB_PROJECTEDREVENUE_365) AS gross
  FROM {p}dated WHERE age = 1 GROUP BY ALL
),
{p}user_value AS (
  SELECT i.APPLICATION_FAMILY_NAME, i.MARKET_CD, i.USER_SOURCE_TYPE_CD,
    CASE WHEN paid.src IS NULL THEN 'ORGANIC' ELSE i.CHANNEL_NAME END AS CHANNEL_NAME,
    CASE WHEN paid.src IS NULL THEN 'ORGANIC' ELSE i.PROMOTION_NAME END AS PROMOTION_NAME,
    i.INSTALL_DT AS CALENDAR_DT, CAST(sum(n) AS BIGINT) AS INDIVIDUAL_INSTALLS,
    {_exact('coalesce(sum(gross * sub), 0)', 'SUB_LTV')}
  FROM {installs} i JOIN {p}per_user USING (ACCOUNT_ID, USER_ID, APPLICATION_CD)
  JOIN {p}sub_shares r ON r.use_ = 'ltv' AND r.app = i.APPLICATION_FAMILY_NAME AND r.market = i.MARKET_CD
    AND i.INSTALL_DT >= r.d_from AND i.INSTALL_DT < r.d_to
  LEFT JOIN paid ON paid.src = i.USER_SOURCE_TYPE_CD
  WHERE i.INSTALL_DT >= {START} AND i.INSTALL_DT <= {end}
  GROUP BY ALL
),
{p}details AS (
  SELECT f.*, coalesce(u.SUB_LTV, 0) AS SUB_LTV, {_exact('f.IAP_LTV + f.AD_LTV + coalesce(u.SUB_LTV, 0)', 'TOTAL_LTV')}
  FROM {p}fact_rollup f LEFT JOIN {p}user_value u ON {_same('f', 'u', CAMPAIGN)}
),
{p}skan_rollup AS (
  SELECT APPLICATION_FAMILY_NAME, 'IT' AS MARKET_CD, 'SKAN' AS SOURCE, CHANNEL_NAME, PROMOTION_CD AS PROMOTION_NAME,
    INSTALL_DT AS CALENDAR_DT, {_names([_exact(x, m) for m, x in skan.items()])}
  FROM skan_ltv JOIN shares ON app = APPLICATION_FAMILY_NAME
  WHERE CHANNEL_NAME NOT LIKE '%UNTRUSTED%' AND INSTALL_DT >= {START} AND INSTALL_DT < {as_of}
  GROUP BY APPLICATION_FAMILY_NAME, CHANNEL_NAME, PROMOTION_CD, INSTALL_DT
),
{p}enriched AS (
  SELECT k.*, coalesce(d.USER_SOURCE_TYPE_CD, 'MK') AS USER_SOURCE_TYPE_CD, coalesce(d.SPEND, 0) AS SPEND
  FROM {p}skan_rollup k LEFT JOIN {p}details d ON {_same('k', 'd', PLACE)}
),
{p}remainder AS (
  SELECT d.*, 'Non-SKAN' AS SOURCE FROM {p}details d
  WHERE NOT EXISTS (SELECT 1 FROM {p}skan_rollup k WHERE {_same('k', 'd', PLACE)})
),
{p}sides AS (
  SELECT 'all' AS side, {_names(DAY_KEYS, METRICS)} FROM {p}details WHERE MARKET_CD = 'IT' AND USER_SOURCE_TYPE_CD IN ('MK', 'US')
  UNION ALL
  SELECT 'unreported', {_names(DAY_KEYS, METRICS)} FROM {p}remainder WHERE MARKET_CD = 'IT' AND USER_SOURCE_TYPE_CD = 'MK'
  UNION ALL
  SELECT 'reported', {_names(DAY_KEYS, METRICS)} FROM {p}enriched
),
{p}residual AS (
  SELECT {_names(DAY_KEYS)}, 'US' AS USER_SOURCE_TYPE_CD, 'Non-SKAN' AS SOURCE, 'ORGANIC' AS CHANNEL_NAME,
    'ORGANIC' AS PROMOTION_NAME, {_names([_exact(f"{plus.format(m)} - {minus.format(m)}", m) for m in METRICS])}
  FROM {p}sides GROUP BY {_names(DAY_KEYS)} HAVING count(*) FILTER (WHERE side = 'all') > 0
),
{p}campaign_raw AS (
  SELECT {_names(FULL, METRICS)} FROM {p}residual
  UNION ALL SELECT {_names(FULL, METRICS)} FROM {p}enriched
  UNION ALL SELECT {_names(FULL, METRICS)} FROM {p}remainder
    WHERE MARKET_CD = 'GO' OR MARKET_CD = 'IT' AND USER_SOURCE_TYPE_CD <> 'US'
),
{p}campaign AS (
  SELECT {_names(FULL, [f"greatest(coalesce({m}, 0), 0) AS {o}" for m, o in zip(METRICS, OUT)])} FROM {p}campaign_raw
),
{p}channel AS (
  SELECT {_names(CHANNEL, [_exact(f"sum({m})", m) for m in OUT])} FROM {p}campaign GROUP BY ALL
)"""


def _query(body: str, *stage_sets: str) -> str:
    return "WITH " + ",".join([RULES, _fixtures(), *stage_sets]) + "\n" + body


def _stage(name: str, keys: list[str], metrics: list[str]) -> str:
    return _query(f"SELECT {_names(keys, [_double(m) for m in metrics])} FROM {name}", _stages())


def _side(side: str, prefix: str) -> str:
    sums = [_double(f"sum({m})", prefix + m) for m in METRICS]
    return _query(f"SELECT {_names(DAY_KEYS, sums)} FROM sides WHERE side = '{side}' GROUP BY ALL", _stages())


def _published(stage: str, metrics: list[str] = OUT, keys: list[str] = FULL) -> str:
    cast = [f"CAST(trunc({m}) AS INTEGER) AS {m}" if m in COUNTS else f"CAST({m} AS FLOAT) AS {m}" for m in metrics]
    return f"SELECT {_names(keys, cast)} FROM {stage}"


def _scoped(keys: list[str], columns: dict[str, str]) -> str:
    cols = [_double(x, m) for m, x in columns.items()]
    return _query(f"SELECT {_names(keys, cols)} FROM netted GROUP BY {_names(keys)}", _stages())


def _q02() -> str:
    columns = {}
    for d in DAYS:
        columns[f"IAP_REVS_DAY_{d}_AMT"] = f"sum({_gross_iap(d)} * iap)"
        if d in ("014", "028"):
            columns[f"IAP_REVS_DAY_{d}_AMT_CLEAN"] = f"sum({_gross_iap(d, legacy=False)} * iap)"
    return _scoped(DAY_KEYS[:2], columns | {"IAP_LTV": "sum(LTV_365_LASTEST_VAL * iap)"})


def _q03() -> str:
    columns = {m: x for d in DAYS for m, x in _net(d).items() if m.startswith("AD_")}
    return _scoped(DAY_KEYS[:2], columns | {"AD_LTV": "sum(AD_LTV_365_LASTEST_VAL * ad)"})


def _q04() -> str:
    return _scoped(DAY_KEYS, {m: x for d in DAYS for m, x in _net(d).items() if m.startswith("SUB_")})


def _q15() -> str:
    some = " OR ".join(f"{m} IS NULL OR {m} < 0" for m in METRICS)
    cols = [_double(f"greatest(coalesce({m}, 0), 0)", o) for m, o in zip(METRICS, OUT)]
    return _query(f"SELECT {_names(FULL, cols)} FROM campaign_raw WHERE {some}", _stages())


def _games(source: str, prefix: str) -> str:
    return f"""SELECT {_names(GAME)}, max(CALENDAR_DT) AS {prefix}LAST_INSTALL_DT,
    sum(CAST(SPEND AS DECIMAL(36,12))) AS {prefix}TOTAL_SPEND, sum(INSTALL) AS {prefix}TOTAL_INSTALL FROM {source} GROUP BY ALL"""


def _gate(cases: dict[str, str], *stage_sets: str) -> str:
    """CTE ``gate``: every game of both sides for each previous publication."""
    old = " UNION ALL ".join(f"SELECT '{case}' AS GATE_CASE, * FROM ({_games(f'({sql}) t', 'OLD_')}) o" for case, sql in cases.items())
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in GAME)
    return f"""
old_game AS ({old}),
new_game AS ({_games('channel', 'NEW_')}),
gate AS (
  SELECT o.*, n.* EXCLUDE ({_names(GAME)}), n.NEW_LAST_INSTALL_DT < o.OLD_LAST_INSTALL_DT AS DATE_WENT_BACK,
    n.NEW_TOTAL_INSTALL < o.OLD_TOTAL_INSTALL - 1 AS INSTALLS_DROPPED,
    n.NEW_TOTAL_SPEND < o.OLD_TOTAL_SPEND * (1 - 0.000001) AS SPEND_DROPPED
  FROM old_game o JOIN new_game n ON {same}
)"""


FAILING = (
    "SELECT * REPLACE (CASE WHEN APPLICATION_FAMILY_NAME = 'ECONOMY' THEN INSTALL * 2 ELSE INSTALL END AS INSTALL) "
    f"FROM ({_published('campaign')}) c"
)
GATE_COLUMNS = _names(
    GAME, "OLD_LAST_INSTALL_DT", "CAST(OLD_TOTAL_INSTALL AS BIGINT) AS OLD_TOTAL_INSTALL", "NEW_LAST_INSTALL_DT",
    _double("round(OLD_TOTAL_SPEND, 2)", "OLD_TOTAL_SPEND"), _double("NEW_TOTAL_SPEND"), _double("NEW_TOTAL_INSTALL"), "GATE_CASE",
)


def _q19() -> str:
    cases = {"pass": _published("e_campaign"), "fail": FAILING}
    body = f"SELECT {GATE_COLUMNS} FROM gate WHERE DATE_WENT_BACK OR INSTALLS_DROPPED"
    return _query(body, _stages(), _stages("e_", EARLIER_RUN), _gate(cases))


def _q24() -> str:
    body = f"SELECT {GATE_COLUMNS}, DATE_WENT_BACK, INSTALLS_DROPPED, SPEND_DROPPED FROM gate"
    return _query(body, _stages(), _gate({"same": _published("campaign"), "fail": FAILING}))


def _digest(columns: list[str]) -> str:
    """Sum of 60 bits of the MD5 of each row's texts, columns by name; fractions in whole 1024ths."""

    def text(c: str) -> str:
        x = f"CAST(floor(CAST({c} AS DOUBLE) * 1024) AS BIGINT)" if c in OUT and c not in COUNTS else c
        return rf"coalesce(CAST({x} AS VARCHAR), '\N')"

    row = " || '|' || ".join(text(c) for c in sorted(columns))
    return f"CAST(sum(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)) AS VARCHAR)"


def _digests(label: str, source: str, keys: list[str]) -> str:
    """What is read back of one output, by application; ``source`` is a published relation."""
    money = [m for m in OUT if m not in COUNTS]
    sums = [f"CAST(sum({m}) AS BIGINT) AS {m}" for m in COUNTS]
    sums += [_double(f"round(sum(CAST({m} AS DECIMAL(36,12))), 2)", m) for m in money]
    return f"""SELECT {label}, APPLICATION_FAMILY_NAME, count(*) AS ROW_COUNT, {_digest(keys)} AS KEY_DIGEST,
  {_digest([*keys, *OUT])} AS ROW_DIGEST, {_names(sums)} FROM ({source}) t GROUP BY APPLICATION_FAMILY_NAME"""


OUTPUTS = (("campaign", FULL), ("channel", CHANNEL))


def _q21() -> str:
    parts = [_digests(f"'{o}_{kind}' AS OUTPUT", _published(o, OUT, keys), keys) for o, keys in OUTPUTS for kind in ("table", "snapshot")]
    return _query(" UNION ALL ".join(parts), _stages())


def _q31() -> str:
    """The rerun replaces SMALL's rows by those of a run without the day-1 quirk."""
    parts = []
    for o, keys in OUTPUTS:
        mixed = f"SELECT * FROM {o} WHERE APPLICATION_FAMILY_NAME <> 'SMALL' UNION ALL SELECT * FROM n_{o} WHERE APPLICATION_FAMILY_NAME = 'SMALL'"
        parts += [_digests(f"'{o}_{kind}' AS OUTPUT", _published(f"({mixed}) m", OUT, keys), keys) for kind in ("table", "snapshot")]
    return _query(" UNION ALL ".join(parts), _stages(), _stages("n_", legacy=False))


def _q36() -> str:
    shown = (("earlier", "e_"), ("current", ""), ("view", "e_"))
    parts = [
        _digests(f"'{o}' AS OUTPUT, '{label}' AS SHOWN", _published(p + o, OUT, keys), keys) for o, keys in OUTPUTS for label, p in shown
    ]
    return _query(" UNION ALL ".join(parts), _stages(), _stages("e_", EARLIER_RUN))


def _q30() -> str:
    """Whole numbers beyond 32 bits do not fit."""
    scaled = {m: f"{m} * 20000000" for m in COUNTS}
    bad = [f"CASE WHEN trunc({x}) > 2147483647 THEN '{m}' END" for m, x in scaled.items()]
    body = f"""SELECT {_names(FULL)}, CASE WHEN REJECTED_METRICS = '' THEN CAST(trunc(INSTALL * 20000000) AS DOUBLE)
  ELSE CAST(INSTALL * 20000000 AS DOUBLE) END AS INSTALL,
  CASE WHEN REJECTED_METRICS = '' THEN 'published' ELSE 'rejected' END AS STATUS, REJECTED_METRICS
FROM (SELECT *, concat_ws(',', {_names(bad)}) AS REJECTED_METRICS FROM campaign) c"""
    return _query(body, _stages())


def _q33() -> str:
    """Each rule as one arm: the published job's two, the spend rule, and two of one market and one source."""
    arms = [
        ("DATE_AHEAD", "SOURCE = 'SKAN' AND NEW_LAST_INSTALL_DT > OLD_LAST_INSTALL_DT + 31"),
        ("DATE_WENT_BACK", "DATE_WENT_BACK"),
        ("INSTALLS_DROPPED", "INSTALLS_DROPPED"),
        ("INSTALLS_GREW", "MARKET_CD = 'GO' AND NEW_TOTAL_INSTALL > OLD_TOTAL_INSTALL * (1 + 0.02)"),
        ("SPEND_DROPPED", "SPEND_DROPPED"),
    ]
    failed = _names([f"CASE WHEN {test} THEN '{name}' END" for name, test in arms])
    cases = {"earlier": _published("e_campaign"), "fail": FAILING}
    body = f"SELECT {GATE_COLUMNS}, concat_ws(',', {failed}) AS FAILED_RULES FROM gate"
    return _query(body, _stages(), _stages("e_", EARLIER_RUN), _gate(cases))


def _q34() -> str:
    users = ["ACCOUNT_ID", "USER_ID", "APPLICATION_CD"]
    money = [f"{k}_PROJECTEDREVENUE_365" for k in ("SUB", "IAP", "AD")]
    first = f"row_number() OVER (PARTITION BY {_names(users)} ORDER BY PROJECTION_DT DESC, {_names([f'{m} DESC' for m in money])})"
    body = f"SELECT {_names(users, 'PROJECTION_DT', [_double(m) for m in money])} FROM (SELECT *, {first} AS n FROM dated) d WHERE n = 1"
    return _query(body, _stages())


def _q25() -> str:
    metrics = [m for m in METRICS if m != "SPEND"]
    body = f"""SELECT {_names(GAME)}, coalesce(arg_min(USER_SOURCE_TYPE_CD, (-spent, USER_SOURCE_TYPE_CD)), 'MK') AS USER_SOURCE_TYPE_CD,
  {_names(PLACE[2:])}, {_double('sum(spent)', 'SPEND')}, {_names([_double(f'any_value({m})', m) for m in metrics])}
FROM (
  SELECT k.*, d.USER_SOURCE_TYPE_CD, coalesce(d.SPEND, 0) AS spent
  FROM skan_rollup k LEFT JOIN details d ON {_same('k', 'd', PLACE)}
) m GROUP BY {_names(GAME, PLACE[2:])}"""
    return _query(body, _stages())


def _q22() -> str:
    def side(name: str, table: str, renamed: str) -> str:
        return f"""SELECT USER_SOURCE_TYPE_CD, CHANNEL_NAME AS RAW_CHANNEL_NAME,
  CASE WHEN paid.src IS NULL THEN 'ORGANIC' ELSE {renamed} END AS CHANNEL_NAME,
  CASE WHEN paid.src IS NULL THEN 'ORGANIC' ELSE PROMOTION_NAME END AS PROMOTION_NAME, count(*) AS ROW_COUNT, '{name}' AS SIDE
FROM {table} LEFT JOIN paid ON src = USER_SOURCE_TYPE_CD LEFT JOIN alias ON raw = CHANNEL_NAME GROUP BY 1, 2, 3, 4"""

    return _query(f"{side('fact', 'promo_fact', 'coalesce(alias.name, CHANNEL_NAME)')} UNION ALL {side('install', 'install', 'CHANNEL_NAME')}")


def _q23() -> str:
    end, as_of, _ = RUN

    def classes(name: str, table: str, day: str, spans: list[tuple[str, str, str]]) -> str:
        arms = " ".join(f"WHEN {day} >= {a} AND {day} < {b} THEN '{label}'" for label, a, b in spans)
        return f"""SELECT CASE {arms} ELSE 'undated' END AS WINDOW_CLASS, count(*) AS ROW_COUNT, min({day}) AS MIN_DT,
  max({day}) AS MAX_DT, '{name}' AS TABLE_NAME FROM {table} GROUP BY 1"""

    after = f"CAST({end} + INTERVAL 1 DAY AS DATE)"
    mmp = [("before_start", EVER, START), ("in_window", START, after), ("lagged_out", after, as_of), ("not_yet", as_of, NEVER)]
    skan = [("before_start", EVER, START), ("in_window", START, as_of), ("not_yet", as_of, NEVER)]
    return _query(
        " UNION ALL ".join(
            [
                classes("fact", "promo_fact", "CALENDAR_DT", mmp),
                classes("install", "install", "INSTALL_DT", mmp),
                classes("skan", "skan_ltv", "INSTALL_DT", skan),
            ]
        )
    )


def oracle_sql() -> dict[str, str]:
    users = ["ACCOUNT_ID", "USER_ID", "APPLICATION_CD", "PROJECTION_DT"]
    return {
        "q01_campaign_rollup": _stage("fact_rollup", CAMPAIGN, METRICS[:-2]),
        "q02_net_iap": _q02(),
        "q03_net_ad": _q03(),
        "q04_net_subscription": _q04(),
        "q05_latest_projection": _query(
            f"SELECT {_names(users, [_double(f'{k}_PROJECTEDREVENUE_365') for k in ('IAP', 'AD', 'SUB')])} FROM dated WHERE age = 1",
            _stages(),
        ),
        "q06_install_ltv": _stage("user_value", [*CAMPAIGN, "INDIVIDUAL_INSTALLS"], ["SUB_LTV"]),
        "q07_campaign_details": _stage("details", CAMPAIGN, METRICS),
        "q08_skan_rollup": _stage("skan_rollup", [*GAME, *PLACE[2:]], METRICS[1:]),
        "q09_precedence_enrich": _stage("enriched", FULL, METRICS),
        "q10_precedence_remainder": _stage("remainder", FULL, METRICS),
        "q11_ios_total": _side("all", "IOS_ALL_"),
        "q12_ios_paid": _side("unreported", "IOS_UNREPORTED_"),
        "q13_skan_total": _side("reported", "IOS_REPORTED_"),
        "q14_residual_raw": _stage("residual", FULL, METRICS),
        "q15_clamp": _q15(),
        "q16_complete_campaign": _stage("campaign", FULL, OUT),
        "q17_channel_rollup": _stage("channel", CHANNEL, OUT),
        "q18_game_rollup": _query(
            f"SELECT {_names(GAME)}, LAST_INSTALL_DT, {_double('TOTAL_SPEND')}, {_double('TOTAL_INSTALL')} FROM ({_games('channel', '')}) g",
            _stages(),
        ),
        "q19_regression_violations": _q19(),
        "q20_published_schema": _query(_published("campaign"), _stages()),
        "q21_sink_roundtrip": _q21(),
        "q22_channel_fold": _q22(),
        "q23_reporting_window": _q23(),
        "q24_gate_outcome": _q24(),
        "q25_precedence_collapse": _q25(),
        "q26_net_by_card_table": _q04(),
        "q27_campaign_rollup_by_cards": _stage("fact_rollup", CAMPAIGN, METRICS[:-2]),
        "q28_install_ltv_by_cards": _stage("user_value", [*CAMPAIGN, "INDIVIDUAL_INSTALLS"], ["SUB_LTV"]),
        "q29_skan_by_cards": _stage("skan_rollup", [*GAME, *PLACE[2:]], METRICS[1:]),
        "q30_published_rejects": _q30(),
        "q31_application_rerun": _q31(),
        "q32_install_ltv_bucketed": _stage("user_value", [*CAMPAIGN, "INDIVIDUAL_INSTALLS"], ["SUB_LTV"]),
        "q33_gate_rules": _q33(),
        "q34_latest_single": _q34(),
        "q35_install_ltv_filtered": _query(
            f"SELECT {_names([*CAMPAIGN, 'INDIVIDUAL_INSTALLS'], [_double('SUB_LTV')])} FROM user_value",
            _stages(installs="(SELECT * FROM install WHERE CHANNEL_NAME NOT LIKE '%UNTRUSTED%')"),
        ),
        "q36_joint_publication": _q36(),
    }
