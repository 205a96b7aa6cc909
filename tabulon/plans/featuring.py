"""Feature tables of the credit model on the stand-in tables."""

from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import encodings as E
from ..operators import features as X
from ..registry import query
from . import standins as S
from .aggregates import dummies_sql, rounds, stats_sql

R = F.round
APP = f"WITH a AS ({S.SQL['app']}) SELECT SK_ID_CURR, "


def row_group(t, names, digits=10):
    df = X.row_features(S.application(t))
    kinds = dict(df.dtypes)
    return df.select("SK_ID_CURR", *[R(n, digits).alias(n) if kinds[n] == "double" else F.col(n) for n in names])


def r(x, name):
    return f'round({x}, 10) + 0 AS "{name}"'


Y = "/ 365.25e0"
EMP = "nullif(DAYS_EMPLOYED, 365243)"
TIME_SQL = ", ".join(
    [r(f"-DAYS_BIRTH {Y}", "AGE_YEARS")]
    + [
        x
        for n, ratio, d in (
            ("EMPLOYED_YEARS", "EMPLOYMENT_AGE_RATIO", EMP),
            ("REGISTRATION_YEARS", "REGISTRATION_AGE_RATIO", "DAYS_REGISTRATION"),
            ("ID_PUBLISH_YEARS", "ID_PUBLISH_AGE_RATIO", "DAYS_ID_PUBLISH"),
            ("PHONE_CHANGE_YEARS", "PHONE_CHANGE_AGE_RATIO", "DAYS_LAST_PHONE_CHANGE"),
        )
        for x in (r(f"-{d} {Y}", n), r(f"(-{d} {Y}) / nullif(-DAYS_BIRTH {Y}, 0)", ratio))
    ]
)


@query("fea1", f"{APP}{TIME_SQL} FROM a")
def time_features(t):
    names = ["AGE_YEARS"]
    for n in X.YEARS:
        names += [f"{n}_YEARS", "EMPLOYMENT_AGE_RATIO" if n == "EMPLOYED" else f"{n}_AGE_RATIO"]
    return row_group(t, names)


FINANCIAL = {
    "CREDIT_INCOME_RATIO": "AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0)",
    "ANNUITY_INCOME_RATIO": "AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0)",
    "GOODS_CREDIT_RATIO": "AMT_GOODS_PRICE / nullif(AMT_CREDIT, 0)",
    "CREDIT_TERM_APPROX": "AMT_CREDIT / nullif(AMT_ANNUITY, 0)",
    "INCOME_PER_PERSON": "AMT_INCOME_TOTAL / nullif(CNT_FAM_MEMBERS, 0)",
    "CHILDREN_RATIO": "CNT_CHILDREN / nullif(CNT_FAM_MEMBERS, 0)",
    "CREDIT_PER_PERSON": "AMT_CREDIT / nullif(CNT_FAM_MEMBERS, 0)",
    "ANNUITY_PER_PERSON": "AMT_ANNUITY / nullif(CNT_FAM_MEMBERS, 0)",
}


@query("fea2", APP + ", ".join(f'round({x}, 8) AS "{n}"' for n, x in FINANCIAL.items()) + " FROM a")
def financial_features(t):
    return row_group(t, list(FINANCIAL), 8)


EXT = "list_filter([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3], lambda x: x IS NOT NULL)"


@query(
    "fea3",
    f"""{APP} round(list_avg({EXT}), 10) AS "EXT_SOURCE_MEAN", round(list_min({EXT}), 10) AS "EXT_SOURCE_MIN", round(list_max({EXT}), 10) AS "EXT_SOURCE_MAX",
        round(list_stddev_pop({EXT}), 10) AS "EXT_SOURCE_STD", CAST(len({EXT}) AS INTEGER) AS "EXT_SOURCE_COUNT" FROM a""",
)
def external_features(t):
    return row_group(t, [f"EXT_SOURCE_{n}" for n in ("MEAN", "MIN", "MAX", "STD", "COUNT")])


def plus(cols):
    return f"CAST({' + '.join(f'coalesce({c}, 0)' for c in cols)} AS DOUBLE)"


DOCS = ["FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3"]


@query(
    "fea4",
    f"{APP} {plus(X.CONTACT)} AS CONTACT_FLAGS_SUM, {plus(X.ADDRESS)} AS ADDRESS_MISMATCH_COUNT, {plus(DOCS)} AS DOCUMENT_COUNT FROM a",
)
def flag_features(t):
    return row_group(t, ["CONTACT_FLAGS_SUM", "ADDRESS_MISMATCH_COUNT", "DOCUMENT_COUNT"])


@query(
    "fea5",
    f"""{APP} REGION_RATING_CLIENT - REGION_RATING_CLIENT_W_CITY AS REGION_RATING_DIFF, CAST(coalesce(WEEKDAY_APPR_PROCESS_START IN ('SATURDAY', 'SUNDAY'), false) AS INTEGER) AS IS_WEEKEND_APPLICATION,
        CAST(coalesce(HOUR_APPR_PROCESS_START IN (0, 1, 2, 3, 4, 5, 22, 23), false) AS INTEGER) AS IS_NIGHT_APPLICATION FROM a""",
)
def region_and_time_flags(t):
    return row_group(t, ["REGION_RATING_DIFF", "IS_WEEKEND_APPLICATION", "IS_NIGHT_APPLICATION"])


@query(
    "fea6",
    f"""{APP} round(DEF_30_CNT_SOCIAL_CIRCLE / nullif(OBS_30_CNT_SOCIAL_CIRCLE, 0), 10) AS SOCIAL_DEFAULT_RATIO_30,
        round(DEF_60_CNT_SOCIAL_CIRCLE / nullif(OBS_60_CNT_SOCIAL_CIRCLE, 0), 10) AS SOCIAL_DEFAULT_RATIO_60, DEF_30_CNT_SOCIAL_CIRCLE + DEF_60_CNT_SOCIAL_CIRCLE AS SOCIAL_DEFAULT_TOTAL FROM a""",
)
def social_features(t):
    return row_group(t, ["SOCIAL_DEFAULT_RATIO_30", "SOCIAL_DEFAULT_RATIO_60", "SOCIAL_DEFAULT_TOTAL"])


def plus_min1(cols):
    return f"CASE WHEN coalesce({', '.join(cols)}) IS NOT NULL THEN {plus(cols)} END"


@query(
    "fea7",
    f"""{APP} {plus_min1(X.REQUESTS)} AS BUREAU_REQUEST_TOTAL, {plus_min1(X.REQUESTS[:4])} AS BUREAU_REQUEST_RECENT,
        round({plus_min1(X.REQUESTS[:4])} / nullif(AMT_REQ_CREDIT_BUREAU_YEAR, 0), 10) AS BUREAU_REQUEST_RECENT_TO_YEAR_RATIO FROM a""",
)
def request_features(t):
    return row_group(t, ["BUREAU_REQUEST_TOTAL", "BUREAU_REQUEST_RECENT", "BUREAU_REQUEST_RECENT_TO_YEAR_RATIO"])


BUILD = "list_filter([APARTMENTS_AVG, FLOORSMAX_MODE, LIVINGAREA_MEDI], lambda x: x IS NOT NULL)"


@query(
    "fea8",
    f"""{APP} round(list_avg({BUILD}), 10) AS BUILDING_FEATURE_MEAN, CAST(3 - len({BUILD}) AS INTEGER) AS BUILDING_FEATURE_MISSING_COUNT,
        CAST(len({BUILD}) AS INTEGER) AS BUILDING_FEATURE_AVAILABLE_COUNT FROM a""",
)
def building_features(t):
    return row_group(t, ["BUILDING_FEATURE_MEAN", "BUILDING_FEATURE_MISSING_COUNT", "BUILDING_FEATURE_AVAILABLE_COUNT"])


def tidy(df):
    """Outputs that are sums of quotients are rounded, so the order of addition does not show."""
    return df.selectExpr(*[f"round(`{n}`, 10) AS `{n}`" if kind == "double" and rounds(n) else f"`{n}`" for n, kind in df.dtypes])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUS_LEVELS = ["0", "1", "2", "3", "5", "C", "X"]
BURO_DERIVED = """*, AMT_CREDIT_SUM_DEBT / nullif(AMT_CREDIT_SUM, 0) AS BURO_DEBT_CREDIT_RATIO, AMT_CREDIT_SUM_OVERDUE / nullif(AMT_CREDIT_SUM, 0) AS BURO_OVERDUE_CREDIT_RATIO,
  DAYS_CREDIT_ENDDATE - DAYS_CREDIT AS BURO_ENDDATE_CREDIT_GAP"""
BB_COLS = (
    ["BB_MONTHS_BALANCE_MEAN", "BB_MONTHS_BALANCE_MAX", "BB_MONTHS_BALANCE_MIN", "BB_MONTHS_BALANCE_COUNT"]
    + [f"BB_STATUS_{v}" for v in [*STATUS_LEVELS, "NAN"]]
    + [f"BB_STATUS_{v}_RATE" for v in [*STATUS_LEVELS, "NAN"]]
    + ["BB_BAD_STATUS_COUNT"]
)
BB_SQL = ", ".join(
    [f"{f}(CAST(MONTHS_BALANCE AS DOUBLE)) AS BB_MONTHS_BALANCE_{n}" for n, f in (("MEAN", "avg"), ("MAX", "max"), ("MIN", "min"), ("COUNT", "count"))]
    + [f"count(*) FILTER (STATUS = '{v}') AS \"BB_STATUS_{v}\"" for v in STATUS_LEVELS]
    + ["count(*) FILTER (STATUS IS NULL) AS BB_STATUS_NAN"]
    + [f"count(*) FILTER (STATUS = '{v}') / count(*) AS \"BB_STATUS_{v}_RATE\"" for v in STATUS_LEVELS]
    + ["count(*) FILTER (STATUS IS NULL) / count(*) AS BB_STATUS_NAN_RATE", "count(*) FILTER (STATUS IN ('1', '2', '3', '4', '5')) AS BB_BAD_STATUS_COUNT"]
)


@query(
    "fea9",
    f"""WITH b AS ({S.SQL['bureau']}), d AS (SELECT {BURO_DERIVED} FROM b), bal AS ({S.SQL['balance']}),
        bb AS (SELECT SK_ID_BUREAU, {BB_SQL} FROM bal GROUP BY 1)
        SELECT SK_ID_CURR, count(*) AS "BURO_RECORD_COUNT", {stats_sql('BURO', X.BUREAU.numerics)}, {dummies_sql('CREDIT_ACTIVE', 'BURO_ACTIVE', ['Active', 'Closed'])},
        {dummies_sql('CREDIT_TYPE', 'BURO_TYPE', PRIORITIES)}, count(DISTINCT CREDIT_CURRENCY) AS "BURO_CREDIT_CURRENCY_NUNIQUE", count(DISTINCT CREDIT_TYPE) AS "BURO_CREDIT_TYPE_NUNIQUE",
        {stats_sql('BURO_BAL', BB_COLS, ('mean', 'max', 'sum'))} FROM d LEFT JOIN bb USING (SK_ID_BUREAU) GROUP BY 1""",
)
def bureau_history(t):
    return tidy(X.bureau_features(S.bureau(t), S.balance(t)))


PREV_LEVELS = {
    "NAME_CONTRACT_TYPE": ["Cash loans", "Consumer loans", "Revolving loans"],
    "WEEKDAY_APPR_PROCESS_START": ["FRIDAY", "MONDAY", "SUNDAY"],
    "FLAG_LAST_APPL_PER_CONTRACT": ["N", "Y"],
    "NAME_CASH_LOAN_PURPOSE": ["Repairs", "Urgent needs"],
    "NAME_CONTRACT_STATUS": ["Approved", "Canceled", "Refused"],
    "NAME_PAYMENT_TYPE": ["Bank", "Cash"],
    "CODE_REJECT_REASON": ["LIMIT", "XAP"],
    "NAME_TYPE_SUITE": ["Alone", "Family"],
    "NAME_CLIENT_TYPE": ["New", "Repeater"],
    "NAME_GOODS_CATEGORY": PRIORITIES[:4],
    "NAME_PORTFOLIO": ["Cash", "POS"],
    "NAME_PRODUCT_TYPE": ["walk-in", "x-sell"],
    "CHANNEL_TYPE": ["Contact center", "Country-wide", "Stone"],
    "NAME_SELLER_INDUSTRY": ["Clothing", "Furniture"],
    "NAME_YIELD_GROUP": ["high", "middle"],
    "PRODUCT_COMBINATION": [f"{p} {s}" for p in PRIORITIES for s in "FOP"],
}
PREV_CLEAN = f"""* REPLACE ({', '.join(f'nullif({c}, 365243) AS {c}' for c in X.PREVIOUS_DAYS)}), AMT_CREDIT / nullif(AMT_APPLICATION, 0) AS PREV_CREDIT_APPLICATION_RATIO,
  AMT_DOWN_PAYMENT / nullif(AMT_APPLICATION, 0) AS PREV_DOWN_PAYMENT_APPLICATION_RATIO, AMT_ANNUITY / nullif(AMT_CREDIT, 0) AS PREV_ANNUITY_CREDIT_RATIO"""


@query(
    "fea10",
    f"""WITH p AS ({S.SQL['prev']}), d AS (SELECT {PREV_CLEAN} FROM p) SELECT SK_ID_CURR, count(*) AS "PREV_RECORD_COUNT", {stats_sql('PREV', X.PREVIOUS.numerics)},
        {', '.join(dummies_sql(c, f'PREV_{c}', PREV_LEVELS[c]) for c in X.PREVIOUS_CATEGORIES)} FROM d GROUP BY 1""",
)
def previous_history(t):
    return tidy(X.history_features(S.previous(t), X.PREVIOUS))


INST_DERIVED = """*, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS INST_PAYMENT_DELAY, AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS INST_PAYMENT_RATIO, AMT_INSTALMENT - AMT_PAYMENT AS INST_PAYMENT_DIFF,
  CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN 1 ELSE 0 END AS INST_LATE_PAYMENT_FLAG, CASE WHEN AMT_INSTALMENT - AMT_PAYMENT > 0 THEN 1 ELSE 0 END AS INST_UNDERPAYMENT_FLAG"""


@query(
    "fea11",
    f"""WITH i AS ({S.SQL['inst']}), d AS (SELECT {INST_DERIVED} FROM i) SELECT SK_ID_CURR, count(*) AS "INST_RECORD_COUNT", {stats_sql('INST', X.INSTALMENTS.numerics)} FROM d GROUP BY 1""",
)
def instalment_history(t):
    return tidy(X.history_features(S.instalments(t), X.INSTALMENTS))


@query(
    "fea12",
    f"""WITH p AS ({S.SQL['pos']}), d AS (SELECT *, 1 - CNT_INSTALMENT_FUTURE / nullif(CNT_INSTALMENT, 0) AS POS_COMPLETION_RATIO FROM p)
        SELECT SK_ID_CURR, count(*) AS "POS_RECORD_COUNT", {stats_sql('POS', X.POS.numerics)}, {dummies_sql('NAME_CONTRACT_STATUS', 'POS_STATUS', ['Active', 'Completed', 'Signed'])} FROM d GROUP BY 1""",
)
def pos_history(t):
    return tidy(X.history_features(S.pos(t), X.POS))


@query(
    "fea13",
    f"""WITH c AS ({S.SQL['card']}), d AS (SELECT *, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS CC_UTILIZATION_RATIO, AMT_PAYMENT_TOTAL_CURRENT / nullif(AMT_INST_MIN_REGULARITY, 0) AS CC_PAYMENT_MIN_RATIO,
        AMT_DRAWINGS_CURRENT / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS CC_DRAWING_LIMIT_RATIO FROM c)
        SELECT SK_ID_CURR, count(*) AS "CC_RECORD_COUNT", {stats_sql('CC', X.CARD.numerics)}, {dummies_sql('NAME_CONTRACT_STATUS', 'CC_STATUS', ['Active', 'Completed'])} FROM d GROUP BY 1""",
)
def card_history(t):
    return tidy(X.history_features(S.card(t), X.CARD))


def w(cond, kind, x=None, cast=None):
    """The SQL of an aggregate over the rows that meet a test, null without such rows."""
    if kind == "count":
        return f"nullif(count(*) FILTER ({cond}), 0)"
    if kind == "sum":
        out = f"CASE WHEN count(*) FILTER ({cond}) > 0 THEN coalesce(sum({x}) FILTER ({cond}), 0) END"
        return f"CAST({out} AS {cast})" if cast else out
    return f"{dict(mean='avg', max='max')[kind]}({x}) FILTER ({cond})"


def buro_recent_sql():
    out = []
    for s in ("Active", "Closed"):
        c, p = f"CREDIT_ACTIVE = '{s}'", f"ADV_BURO_{s.upper()}"
        debt, credit = w(c, "sum", "AMT_CREDIT_SUM_DEBT"), w(c, "sum", "AMT_CREDIT_SUM")
        out += [f"{w(c, 'count')} AS {p}_RECORD_COUNT", f"{debt} AS {p}_DEBT_SUM", f"{credit} AS {p}_CREDIT_SUM"]
        out.append(f"round({debt} / nullif({credit}, 0), 10) AS {p}_DEBT_CREDIT_RATIO")
    c = "CREDIT_ACTIVE = 'Active'"
    out.append(f"{w(c, 'max', 'AMT_CREDIT_MAX_OVERDUE')} AS ADV_BURO_ACTIVE_MAX_OVERDUE")
    out.append(f"{w(c, 'max', 'CREDIT_DAY_OVERDUE')} AS ADV_BURO_ACTIVE_MAX_DAYS_OVERDUE")
    for m, d in X.MONTHS.items():
        c, p = f"DAYS_CREDIT >= -{d}", f"ADV_BURO_LAST_{m}M"
        n = w(c, "count")
        act = w(c, "sum", "CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END", "BIGINT")
        over = w(c, "sum", "CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END", "BIGINT")
        debt, credit = w(c, "sum", "AMT_CREDIT_SUM_DEBT"), w(c, "sum", "AMT_CREDIT_SUM")
        out += [
            f"{n} AS {p}_RECORD_COUNT",
            f"{act} AS {p}_ACTIVE_COUNT",
            f"round({act} / nullif({n}, 0), 10) AS {p}_ACTIVE_RATIO",
            f"{over} AS {p}_OVERDUE_COUNT",
            f"round({over} / nullif({n}, 0), 10) AS {p}_OVERDUE_RATIO",
            f"{debt} AS {p}_DEBT_SUM",
            f"{credit} AS {p}_CREDIT_SUM",
            f"round({debt} / nullif({credit}, 0), 10) AS {p}_DEBT_CREDIT_RATIO",
            f"{w(c, 'max', 'AMT_CREDIT_SUM_OVERDUE')} AS {p}_MAX_OVERDUE",
        ]
    return ", ".join(out)


@query("fea14", f"WITH b AS ({S.SQL['bureau']}) SELECT SK_ID_CURR, {buro_recent_sql()} FROM b GROUP BY 1")
def bureau_recent(t):
    return tidy(X.bureau_recent(S.bureau(t)))


def recent_sql(time, windows, prefix, measures):
    out = []
    for m, d in windows.items():
        c = f"{time} >= -{d}"
        for name, kind, x, cast in measures:
            body = w(c, kind, x, cast)
            label = f"{prefix}_LAST_{m}M_{name}"
            out.append(f"{f'round({body}, 10) + 0' if kind == 'mean' else body} AS {label}")
    return ", ".join(out)


def flag_sql(cond):
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def tidy_recent(df):
    means = [n for n, k in df.dtypes if k == "double" and not n.endswith(("_MAX", "_SUM"))]
    return df.withColumns({n: R(n, 10) for n in means})


@query(
    "fea15",
    f"WITH p AS ({S.SQL['prev']}) SELECT SK_ID_CURR, "
    + recent_sql(
        "DAYS_DECISION",
        X.MONTHS,
        "ADV_PREV",
        [
            ("RECORD_COUNT", "count", None, None),
            ("REFUSED_COUNT", "sum", flag_sql("NAME_CONTRACT_STATUS = 'Refused'"), "BIGINT"),
            ("APPROVED_COUNT", "sum", flag_sql("NAME_CONTRACT_STATUS = 'Approved'"), "BIGINT"),
            ("REFUSED_RATE", "mean", flag_sql("NAME_CONTRACT_STATUS = 'Refused'"), None),
            ("CREDIT_APPLICATION_RATIO_MEAN", "mean", "AMT_CREDIT / nullif(AMT_APPLICATION, 0)", None),
            ("CNT_PAYMENT_MEAN", "mean", "CNT_PAYMENT", None),
        ],
    )
    + " FROM p WHERE DAYS_DECISION >= -730 GROUP BY 1",
)
def previous_recent(t):
    return tidy_recent(X.previous_recent(S.previous(t)))


DELAY = "(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)"
UNDER = "CASE WHEN AMT_INSTALMENT - AMT_PAYMENT IS NOT NULL THEN greatest(AMT_INSTALMENT - AMT_PAYMENT, 0) END"


@query(
    "fea16",
    f"WITH i AS ({S.SQL['inst']}) SELECT SK_ID_CURR, "
    + recent_sql(
        "DAYS_INSTALMENT",
        X.MONTHS,
        "ADV_INST",
        [
            ("RECORD_COUNT", "count", None, None),
            ("LATE_RATE", "mean", flag_sql(f"{DELAY} > 0"), None),
            ("LATE_COUNT", "sum", flag_sql(f"{DELAY} > 0"), "BIGINT"),
            ("LATE_DELAY_MEAN_ONLY", "mean", f"CASE WHEN {DELAY} > 0 THEN {DELAY} END", None),
            ("LATE_DELAY_MAX", "max", DELAY, None),
            ("UNDERPAYMENT_RATE", "mean", flag_sql(f"{UNDER} > 0"), None),
            ("UNDERPAYMENT_AMOUNT_SUM", "sum", UNDER, None),
        ],
    )
    + " FROM i WHERE DAYS_INSTALMENT >= -730 GROUP BY 1",
)
def instalments_recent(t):
    return tidy_recent(X.instalments_recent(S.instalments(t)))


USE = "(AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0))"


@query(
    "fea17",
    f"WITH c AS ({S.SQL['card']}) SELECT SK_ID_CURR, "
    + recent_sql(
        "MONTHS_BALANCE",
        X.SAME_MONTHS,
        "ADV_CC",
        [
            ("RECORD_COUNT", "count", None, None),
            ("UTILIZATION_MEAN", "mean", USE, None),
            ("UTILIZATION_MAX", "max", USE, None),
            ("DPD_RATE", "mean", flag_sql("SK_DPD > 0"), None),
            ("DPD_DEF_RATE", "mean", flag_sql("SK_DPD_DEF > 0"), None),
            ("DPD_MAX", "max", "SK_DPD", None),
        ],
    )
    + f""", round(avg({USE}) FILTER (MONTHS_BALANCE >= -6) - avg({USE}) FILTER (MONTHS_BALANCE < -6 AND MONTHS_BALANCE >= -12), 10) + 0 AS ADV_CC_UTILIZATION_LAST6_MINUS_PREV6
      FROM c WHERE MONTHS_BALANCE >= -24 GROUP BY 1""",
)
def card_recent(t):
    return tidy_recent(X.card_recent(S.card(t)))


@query(
    "fea18",
    f"WITH p AS ({S.SQL['pos']}) SELECT SK_ID_CURR, "
    + recent_sql(
        "MONTHS_BALANCE",
        X.SAME_MONTHS,
        "ADV_POS",
        [
            ("RECORD_COUNT", "count", None, None),
            ("DPD_RATE", "mean", flag_sql("SK_DPD > 0"), None),
            ("DPD_DEF_RATE", "mean", flag_sql("SK_DPD_DEF > 0"), None),
            ("DPD_MAX", "max", "SK_DPD", None),
            ("COMPLETED_RATE", "mean", flag_sql("NAME_CONTRACT_STATUS = 'Completed'"), None),
        ],
    )
    + " FROM p WHERE MONTHS_BALANCE >= -24 GROUP BY 1",
)
def pos_recent(t):
    return tidy_recent(X.pos_recent(S.pos(t)))


def avg_if(x, cond):
    return f"avg({x}) FILTER ({cond})"


LATE = flag_sql(f"{DELAY} > 0")
WEIGHT = "exp(-greatest(-DAYS_DECISION / 30.0, 0) / 12.0)"
REFUSED = flag_sql("NAME_CONTRACT_STATUS = 'Refused'")


@query(
    "fea19",
    f"""WITH b AS ({S.SQL['bureau']}), c AS ({S.SQL['card']}), i AS ({S.SQL['inst']}), p AS ({S.SQL['prev']}), q AS ({S.SQL['pos']}),
        fa AS (SELECT SK_ID_CURR, {w('DAYS_CREDIT >= -180', 'sum', 'AMT_CREDIT_SUM_OVERDUE')} / nullif({w('DAYS_CREDIT >= -730', 'sum', 'AMT_CREDIT_SUM_OVERDUE')}, 0) AS a1 FROM b GROUP BY 1),
        fb AS (SELECT SK_ID_CURR, {avg_if(USE, 'MONTHS_BALANCE >= -6')} - {avg_if(USE, 'MONTHS_BALANCE < -6 AND MONTHS_BALANCE >= -12')} AS b1 FROM c GROUP BY 1),
        fc AS (SELECT SK_ID_CURR, {avg_if(LATE, 'DAYS_INSTALMENT >= -90')} AS l3, {avg_if(LATE, 'DAYS_INSTALMENT >= -180')} AS l6, {avg_if(LATE, 'DAYS_INSTALMENT >= -365')} AS l12 FROM i GROUP BY 1),
        fd AS (SELECT SK_ID_CURR, sum({REFUSED} * {WEIGHT}) / nullif(sum({WEIGHT}), 0) AS d1 FROM p GROUP BY 1),
        fe AS (SELECT SK_ID_CURR, {', '.join(f"{avg_if(flag_sql(f'{c} > 0'), f'MONTHS_BALANCE >= -{m}')} AS {n}{m}" for n, c in (('k', 'SK_DPD'), ('f', 'SK_DPD_DEF')) for m in (3, 6, 12))} FROM q GROUP BY 1)
        SELECT SK_ID_CURR, {r('a1', 'SO_BURO_OVERDUE_SUM_6M_TO_24M_RATIO')}, {r('b1', 'SO_CC_UTILIZATION_CURRENT6_MINUS_PRIOR6')}, {r('l3 - l6', 'SO_INST_LATE_RATE_3M_MINUS_6M')},
        {r('l6 - l12', 'SO_INST_LATE_RATE_6M_MINUS_12M')}, {r('(l3 - l6) - (l6 - l12)', 'SO_INST_LATE_RATE_ACCEL_3_6_12M')}, {r('d1', 'SO_PREV_RECENCY_WEIGHTED_REFUSAL_RATE')},
        {r('k3 - k6', 'SO_POS_DPD_RATE_3M_MINUS_6M')}, {r('k6 - k12', 'SO_POS_DPD_RATE_6M_MINUS_12M')}, {r('(k3 - k6) - (k6 - k12)', 'SO_POS_DPD_RATE_ACCEL_3_6_12M')},
        {r('f3 - f6', 'SO_POS_DPD_DEF_RATE_3M_MINUS_6M')}, {r('f6 - f12', 'SO_POS_DPD_DEF_RATE_6M_MINUS_12M')}
        FROM fa FULL JOIN fb USING (SK_ID_CURR) FULL JOIN fc USING (SK_ID_CURR) FULL JOIN fd USING (SK_ID_CURR) FULL JOIN fe USING (SK_ID_CURR)""",
)
def second_order(t):
    out = X.second_order(S.bureau(t), S.card(t), S.instalments(t), S.previous(t), S.pos(t))
    return out.select("SK_ID_CURR", *[R(c, 10).alias(c) for c in out.columns if c != "SK_ID_CURR"])


def category_sql(c):
    return (
        f"(SELECT SK_ID_CURR, {c} AS recent FROM (SELECT SK_ID_CURR, {c}, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC, {c} DESC) AS rn FROM p WHERE {c} IS NOT NULL) WHERE rn = 1)",
        f"(SELECT SK_ID_CURR, {c} AS modal FROM (SELECT SK_ID_CURR, {c}, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY count(*) DESC, {c}) AS rn FROM p WHERE {c} IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)",
    )


@query(
    "fea20",
    f"WITH p AS ({S.SQL['prev']}), k AS (SELECT DISTINCT SK_ID_CURR FROM p) SELECT k.SK_ID_CURR, "
    + ", ".join(f"r{i}.recent AS CAT_PREV_RECENT_{c}, m{i}.modal AS CAT_PREV_MODE_{c}" for i, c in enumerate(X.ENCODED_PREVIOUS))
    + " FROM k "
    + " ".join(
        f"LEFT JOIN {category_sql(c)[0]} r{i} ON r{i}.SK_ID_CURR = k.SK_ID_CURR LEFT JOIN {category_sql(c)[1]} m{i} ON m{i}.SK_ID_CURR = k.SK_ID_CURR"
        for i, c in enumerate(X.ENCODED_PREVIOUS)
    ),
)
def category_history(t):
    return X.previous_categories(S.previous(t))


KEPT = [
    "AMT_CREDIT",
    "EXT_SOURCE_COUNT",
    "BURO_RECORD_COUNT",
    "BURO_AMT_CREDIT_SUM_SUM",
    "PREV_AMT_APPLICATION_MAX",
    "INST_AMT_PAYMENT_SUM",
    "INST_INST_LATE_PAYMENT_FLAG_SUM",
    "NOT_A_COLUMN",
    "BURO_RECORD_COUNT",
]


@query(
    "fea21",
    f"""WITH a AS ({S.SQL['app']}), b AS ({S.SQL['bureau']}), p AS ({S.SQL['prev']}), i AS ({S.SQL['inst']}),
        fb AS (SELECT SK_ID_CURR, count(*) AS rc, sum(AMT_CREDIT_SUM) AS s FROM b GROUP BY 1), fp AS (SELECT SK_ID_CURR, max(CAST(AMT_APPLICATION AS DOUBLE)) AS m FROM p GROUP BY 1),
        fi AS (SELECT SK_ID_CURR, coalesce(sum(AMT_PAYMENT), 0) AS s, CAST(sum({LATE}) AS DOUBLE) AS l FROM i GROUP BY 1)
        SELECT a.SK_ID_CURR, AMT_CREDIT, CAST(len({EXT}) AS INTEGER) AS "EXT_SOURCE_COUNT", rc AS "BURO_RECORD_COUNT", fb.s AS "BURO_AMT_CREDIT_SUM_SUM", fp.m AS "PREV_AMT_APPLICATION_MAX", fi.s AS "INST_AMT_PAYMENT_SUM",
        fi.l AS "INST_INST_LATE_PAYMENT_FLAG_SUM" FROM a LEFT JOIN fb USING (SK_ID_CURR) LEFT JOIN fp USING (SK_ID_CURR) LEFT JOIN fi USING (SK_ID_CURR)""",
)
def reduced_matrix(t):
    groups = [
        X.bureau_features(S.bureau(t)),
        X.history_features(S.previous(t), X.PREVIOUS),
        X.history_features(S.instalments(t), X.INSTALMENTS),
    ]
    return X.joined_matrix(X.row_features(S.application(t)), groups, KEPT)


JOINED = f"WITH a0 AS ({S.SQL['app']}), tg AS ({S.SQL['target']}), a AS (SELECT a0.*, TARGET, fold FROM a0 JOIN tg USING (SK_ID_CURR))"


def with_target(t):
    return S.application(t).join(S.targets(t), "SK_ID_CURR")


@query(
    "fea22",
    f"{JOINED} SELECT ORGANIZATION_TYPE, avg(TARGET) AS te FROM a WHERE ORGANIZATION_TYPE IS NOT NULL GROUP BY 1 HAVING count(*) >= 50",
)
def fit_target_encoding(t):
    return E.fit_encoding(with_target(t), "ORGANIZATION_TYPE", "TARGET")


@query(
    "fea23",
    f"""{JOINED}, m AS (SELECT OCCUPATION_TYPE, avg(TARGET) AS te FROM a WHERE fold <> 0 AND OCCUPATION_TYPE IS NOT NULL GROUP BY 1 HAVING count(*) >= 50)
        SELECT SK_ID_CURR, coalesce(te, (SELECT avg(TARGET) FROM a WHERE fold <> 0)) AS "TE_APP_OCCUPATION_TYPE" FROM a LEFT JOIN m USING (OCCUPATION_TYPE) WHERE fold = 0""",
)
def apply_target_encoding(t):
    df = with_target(t)
    train, valid = df.filter("fold <> 0"), df.filter("fold = 0")
    encoding = E.fit_encoding(train, "OCCUPATION_TYPE", "TARGET")
    out = E.apply_encoding(valid, "OCCUPATION_TYPE", encoding, E.global_mean(train, "TARGET"), "TE_APP_OCCUPATION_TYPE")
    return out.select("SK_ID_CURR", "TE_APP_OCCUPATION_TYPE")


def child_sql(column, fit, use):
    return f"""c AS (SELECT p.SK_ID_CURR, p.{column} AS v, TARGET, fold FROM p JOIN tg USING (SK_ID_CURR)), m AS (SELECT v, avg(TARGET) AS te FROM c WHERE {fit} AND v IS NOT NULL GROUP BY 1 HAVING count(*) >= 50),
        g AS (SELECT avg(TARGET) AS mu FROM c WHERE {fit}), e AS (SELECT SK_ID_CURR, coalesce(te, mu) AS x FROM c LEFT JOIN m USING (v), g WHERE {use}), s AS (SELECT SK_ID_CURR, avg(x) AS a, max(x) AS b, count(*) AS n FROM e GROUP BY 1)"""


@query(
    "fea24",
    f"""WITH tg AS ({S.SQL['target']}), p AS ({S.SQL['prev']}), {child_sql('NAME_GOODS_CATEGORY', 'fold <> 0', 'fold = 0')}
        SELECT SK_ID_CURR, round(coalesce(a, mu), 10) AS "TE_PREV_NAME_GOODS_CATEGORY_MEAN", round(coalesce(b, mu), 10) AS "TE_PREV_NAME_GOODS_CATEGORY_MAX", coalesce(n, 0) AS "TE_PREV_NAME_GOODS_CATEGORY_COUNT"
        FROM tg LEFT JOIN s USING (SK_ID_CURR), g WHERE fold = 0""",
)
def child_target_encoding(t):
    y = S.targets(t)
    return tidy(E.child_encoding(S.previous(t), "NAME_GOODS_CATEGORY", y.filter("fold <> 0"), y.filter("fold = 0")))


@query(
    "fea25",
    f"""{JOINED} SELECT x.SK_ID_CURR, round(coalesce((SELECT avg(TARGET) FROM a y WHERE y.ORGANIZATION_TYPE = x.ORGANIZATION_TYPE AND y.fold <> x.fold HAVING count(*) >= 50),
        (SELECT avg(TARGET) FROM a z WHERE z.fold <> x.fold)), 10) AS "TE_APP_ORGANIZATION_TYPE" FROM a x""",
)
def out_of_fold_encoding(t):
    out = E.out_of_fold(with_target(t), "ORGANIZATION_TYPE", "TARGET", "fold", "TE_APP_ORGANIZATION_TYPE")
    return tidy(out.select("SK_ID_CURR", "TE_APP_ORGANIZATION_TYPE"))


FOLD_SQL = " UNION ALL ".join(
    f"SELECT SK_ID_CURR, {k} AS fold, coalesce(te, mu) AS x FROM (SELECT * FROM c WHERE fold = {k}) LEFT JOIN (SELECT v, avg(TARGET) AS te FROM c WHERE fold <> {k} AND v IS NOT NULL GROUP BY 1 HAVING count(*) >= 50) USING (v), (SELECT avg(TARGET) AS mu FROM c WHERE fold <> {k})"
    for k in range(3)
)


@query(
    "fea25_child",
    f"""WITH tg AS ({S.SQL['target']}), p AS ({S.SQL['prev']}), c AS (SELECT p.SK_ID_CURR, p.PRODUCT_COMBINATION AS v, TARGET, fold FROM p JOIN tg USING (SK_ID_CURR)),
        e AS ({FOLD_SQL}), s AS (SELECT SK_ID_CURR, avg(x) AS a, max(x) AS b, count(*) AS n FROM e GROUP BY 1), g AS (SELECT f AS fold, (SELECT avg(TARGET) FROM c WHERE fold <> f) AS mu FROM range(3) r(f))
        SELECT tg.SK_ID_CURR, round(coalesce(a, mu), 10) AS "TE_PREV_PRODUCT_COMBINATION_MEAN", round(coalesce(b, mu), 10) AS "TE_PREV_PRODUCT_COMBINATION_MAX", coalesce(n, 0) AS "TE_PREV_PRODUCT_COMBINATION_COUNT"
        FROM tg LEFT JOIN s ON tg.SK_ID_CURR = s.SK_ID_CURR JOIN g ON g.fold = tg.fold""",
)
def child_out_of_fold(t):
    return tidy(E.child_out_of_fold(S.previous(t), "PRODUCT_COMBINATION", S.targets(t)))


@query(
    "fea26",
    """SELECT p_partkey, p_size * 1.0::DOUBLE AS x, CAST(p_size * p_size AS DOUBLE) AS x2, round(p_retailprice / 1000, 10) AS y, round(p_size * (p_retailprice / 1000), 10) AS xy,
       round(pow(p_retailprice / 1000, 2), 10) AS y2, round(p_retailprice / p_size, 8) AS ratio, round(ln(1 + p_size), 10) AS log_x FROM part""",
)
def polynomial_features(t):
    df = t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 1000).alias("y"), "p_retailprice")
    vec = VectorAssembler(inputCols=["x", "y"], outputCol="v").transform(df)
    poly = PolynomialExpansion(degree=2, inputCol="v", outputCol="p").transform(vec).withColumn("a", vector_to_array("p"))
    names = ["x", "x2", "y", "xy", "y2"]
    return poly.select(
        "p_partkey",
        *[R(F.col("a")[i], 10).alias(n) for i, n in enumerate(names)],
        R(F.col("p_retailprice") / F.col("x"), 8).alias("ratio"),
        R(F.log1p("x"), 10).alias("log_x"),
    )
