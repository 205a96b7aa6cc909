"""Feature tables of the credit model: row features and history features, one row per applicant.

Column names are the ones of the input tables. What to build is stated as data; one projection or
one ``groupBy`` per table does the work.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import aggregate as A

KEY = "SK_ID_CURR"

# The code for "no day known" and the days of a year.
NO_DAY = 365243
YEAR = 365.25

# Column groups of the application table.
CONTACT = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"]
ADDRESS = [
    "REG_REGION_NOT_LIVE_REGION",
    "REG_REGION_NOT_WORK_REGION",
    "LIVE_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_LIVE_CITY",
    "REG_CITY_NOT_WORK_CITY",
    "LIVE_CITY_NOT_WORK_CITY",
]
EXTERNAL = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
REQUESTS = [f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]
YEARS = {
    "EMPLOYED": "DAYS_EMPLOYED",
    "REGISTRATION": "DAYS_REGISTRATION",
    "ID_PUBLISH": "DAYS_ID_PUBLISH",
    "PHONE_CHANGE": "DAYS_LAST_PHONE_CHANGE",
}
# output -> (numerator, denominator)
RATIOS = {
    "CREDIT_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "GOODS_CREDIT_RATIO": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
    "CREDIT_TERM_APPROX": ("AMT_CREDIT", "AMT_ANNUITY"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "CHILDREN_RATIO": ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    "CREDIT_PER_PERSON": ("AMT_CREDIT", "CNT_FAM_MEMBERS"),
    "ANNUITY_PER_PERSON": ("AMT_ANNUITY", "CNT_FAM_MEMBERS"),
    "SOCIAL_DEFAULT_RATIO_30": ("DEF_30_CNT_SOCIAL_CIRCLE", "OBS_30_CNT_SOCIAL_CIRCLE"),
    "SOCIAL_DEFAULT_RATIO_60": ("DEF_60_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"),
}


def _candidates(df: DataFrame) -> list[tuple[str, list[str], Callable[[], Column]]]:
    """(output, inputs it needs, expression) of every row feature."""
    age = -F.col("DAYS_BIRTH") / YEAR if "DAYS_BIRTH" in df.columns else None
    out = [("AGE_YEARS", ["DAYS_BIRTH"], lambda: age)]
    for name, day in YEARS.items():
        years = lambda d=day: -(C.sentinel_to_null(d, NO_DAY) if d == "DAYS_EMPLOYED" else F.col(d)) / YEAR
        ratio = "EMPLOYMENT_AGE_RATIO" if name == "EMPLOYED" else f"{name}_AGE_RATIO"
        out.append((f"{name}_YEARS", [day], years))
        out.append((ratio, [day, "DAYS_BIRTH"], lambda y=years: C.safe_divide(y(), age)))
    for name, (num, den) in RATIOS.items():
        out.append((name, [num, den], lambda n=num, d=den: C.safe_divide(F.col(n).cast("double"), d)))
    for name, fn in (("MEAN", C.row_mean), ("MIN", C.row_min), ("MAX", C.row_max), ("STD", C.row_std), ("COUNT", C.row_count)):
        out.append((f"EXT_SOURCE_{name}", EXTERNAL, lambda f=fn: f(EXTERNAL)))
    out += [
        ("CONTACT_FLAGS_SUM", CONTACT, lambda: C.row_total(CONTACT)),
        ("ADDRESS_MISMATCH_COUNT", ADDRESS, lambda: C.row_total(ADDRESS)),
        (
            "REGION_RATING_DIFF",
            ["REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY"],
            lambda: F.col("REGION_RATING_CLIENT") - F.col("REGION_RATING_CLIENT_W_CITY"),
        ),
        (
            "IS_WEEKEND_APPLICATION",
            ["WEEKDAY_APPR_PROCESS_START"],
            lambda: C.flag(F.col("WEEKDAY_APPR_PROCESS_START").isin("SATURDAY", "SUNDAY")),
        ),
        (
            "IS_NIGHT_APPLICATION",
            ["HOUR_APPR_PROCESS_START"],
            lambda: C.flag(F.col("HOUR_APPR_PROCESS_START").isin(0, 1, 2, 3, 4, 5, 22, 23)),
        ),
        (
            "SOCIAL_DEFAULT_TOTAL",
            ["DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE"],
            lambda: F.col("DEF_30_CNT_SOCIAL_CIRCLE") + F.col("DEF_60_CNT_SOCIAL_CIRCLE"),
        ),
        ("BUREAU_REQUEST_TOTAL", REQUESTS, lambda: C.row_total(REQUESTS, 1)),
        ("BUREAU_REQUEST_RECENT", REQUESTS, lambda: C.row_total(REQUESTS[:4], 1)),
        ("BUREAU_REQUEST_RECENT_TO_YEAR_RATIO", REQUESTS, lambda: C.safe_divide(C.row_total(REQUESTS[:4], 1), REQUESTS[-1])),
    ]
    documents = C.columns_like(df, prefix="FLAG_DOCUMENT_")
    if documents:
        out.append(("DOCUMENT_COUNT", documents, lambda: C.row_total(documents)))
    building = C.columns_like(df, suffix=("_AVG", "_MODE", "_MEDI"), numeric=True)
    if building:
        out += [
            ("BUILDING_FEATURE_MEAN", building, lambda: C.row_mean(building)),
            ("BUILDING_FEATURE_MISSING_COUNT", building, lambda: len(building) - C.row_count(building)),
            ("BUILDING_FEATURE_AVAILABLE_COUNT", building, lambda: C.row_count(building)),
        ]
    return out


def row_features(df: DataFrame) -> DataFrame:
    """The table with every row feature whose inputs exist; the birth day itself is dropped."""
    made = {name: make() for name, needs, make in _candidates(df) if C.has_all(df, needs)}
    if "DAYS_EMPLOYED" in df.columns:
        made["DAYS_EMPLOYED"] = C.sentinel_to_null("DAYS_EMPLOYED", NO_DAY)
    return df.withColumns(made).drop("DAYS_BIRTH")


@dataclass
class History:
    """A child table: what to derive per row and what to aggregate per applicant."""

    prefix: str
    numerics: list[str]
    categories: dict[str, str] = field(default_factory=dict)
    sentinels: list[str] = field(default_factory=list)
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def prepare(self, df: DataFrame) -> DataFrame:
        clean = {c: C.sentinel_to_null(c, NO_DAY) for c in C.present(df, self.sentinels)}
        df = df.withColumns(clean) if clean else df
        return df.withColumns({n: make() for n, make in self.derived.items()}) if self.derived else df

    @property
    def inputs(self) -> list[str]:
        return [c for c in self.numerics if c not in self.derived]


def history_features(df: DataFrame, spec: History) -> DataFrame:
    """PREFIX_RECORD_COUNT, every statistic of every number, counts and rates of every category."""
    wide, _ = A.key_profile(
        spec.prepare(df), KEY, spec.prefix, spec.numerics, spec.categories, record_count=f"{spec.prefix}_RECORD_COUNT"
    )
    return wide


# Which columns of each child table are aggregated.
BUREAU = History(
    "BURO",
    [
        "DAYS_CREDIT",
        "CREDIT_DAY_OVERDUE",
        "DAYS_CREDIT_ENDDATE",
        "DAYS_ENDDATE_FACT",
        "AMT_CREDIT_MAX_OVERDUE",
        "CNT_CREDIT_PROLONG",
        "AMT_CREDIT_SUM",
        "AMT_CREDIT_SUM_DEBT",
        "AMT_CREDIT_SUM_LIMIT",
        "AMT_CREDIT_SUM_OVERDUE",
        "DAYS_CREDIT_UPDATE",
        "AMT_ANNUITY",
        "BURO_DEBT_CREDIT_RATIO",
        "BURO_OVERDUE_CREDIT_RATIO",
        "BURO_ENDDATE_CREDIT_GAP",
    ],
    {"CREDIT_ACTIVE": "BURO_ACTIVE", "CREDIT_TYPE": "BURO_TYPE"},
    derived={
        "BURO_DEBT_CREDIT_RATIO": lambda: C.safe_divide("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
        "BURO_OVERDUE_CREDIT_RATIO": lambda: C.safe_divide("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM"),
        "BURO_ENDDATE_CREDIT_GAP": lambda: F.col("DAYS_CREDIT_ENDDATE") - F.col("DAYS_CREDIT"),
    },
)
PREVIOUS_DAYS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"]
PREVIOUS_CATEGORIES = [
    "NAME_CONTRACT_TYPE",
    "WEEKDAY_APPR_PROCESS_START",
    "FLAG_LAST_APPL_PER_CONTRACT",
    "NAME_CASH_LOAN_PURPOSE",
    "NAME_CONTRACT_STATUS",
    "NAME_PAYMENT_TYPE",
    "CODE_REJECT_REASON",
    "NAME_TYPE_SUITE",
    "NAME_CLIENT_TYPE",
    "NAME_GOODS_CATEGORY",
    "NAME_PORTFOLIO",
    "NAME_PRODUCT_TYPE",
    "CHANNEL_TYPE",
    "NAME_SELLER_INDUSTRY",
    "NAME_YIELD_GROUP",
    "PRODUCT_COMBINATION",
]
PREVIOUS = History(
    "PREV",
    [
        "AMT_ANNUITY",
        "AMT_APPLICATION",
        "AMT_CREDIT",
        "AMT_DOWN_PAYMENT",
        "AMT_GOODS_PRICE",
        "HOUR_APPR_PROCESS_START",
        "NFLAG_LAST_APPL_IN_DAY",
        "RATE_DOWN_PAYMENT",
        "RATE_INTEREST_PRIMARY",
        "RATE_INTEREST_PRIVILEGED",
        "DAYS_DECISION",
        "SELLERPLACE_AREA",
        "CNT_PAYMENT",
        *PREVIOUS_DAYS,
        "NFLAG_INSURED_ON_APPROVAL",
        "PREV_CREDIT_APPLICATION_RATIO",
        "PREV_DOWN_PAYMENT_APPLICATION_RATIO",
        "PREV_ANNUITY_CREDIT_RATIO",
    ],
    {c: f"PREV_{c}" for c in PREVIOUS_CATEGORIES},
    PREVIOUS_DAYS,
    {
        "PREV_CREDIT_APPLICATION_RATIO": lambda: C.safe_divide("AMT_CREDIT", "AMT_APPLICATION"),
        "PREV_DOWN_PAYMENT_APPLICATION_RATIO": lambda: C.safe_divide("AMT_DOWN_PAYMENT", "AMT_APPLICATION"),
        "PREV_ANNUITY_CREDIT_RATIO": lambda: C.safe_divide("AMT_ANNUITY", "AMT_CREDIT"),
    },
)
DELAY = lambda: F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
SHORT = lambda: F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")
INSTALMENTS = History(
    "INST",
    [
        "NUM_INSTALMENT_VERSION",
        "NUM_INSTALMENT_NUMBER",
        "DAYS_INSTALMENT",
        "DAYS_ENTRY_PAYMENT",
        "AMT_INSTALMENT",
        "AMT_PAYMENT",
        "INST_PAYMENT_DELAY",
        "INST_PAYMENT_RATIO",
        "INST_PAYMENT_DIFF",
        "INST_LATE_PAYMENT_FLAG",
        "INST_UNDERPAYMENT_FLAG",
    ],
    derived={
        "INST_PAYMENT_DELAY": DELAY,
        "INST_PAYMENT_RATIO": lambda: C.safe_divide("AMT_PAYMENT", "AMT_INSTALMENT"),
        "INST_PAYMENT_DIFF": SHORT,
        "INST_LATE_PAYMENT_FLAG": lambda: C.flag(DELAY() > 0),
        "INST_UNDERPAYMENT_FLAG": lambda: C.flag(SHORT() > 0),
    },
)
POS = History(
    "POS",
    ["MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF", "POS_COMPLETION_RATIO"],
    {"NAME_CONTRACT_STATUS": "POS_STATUS"},
    derived={"POS_COMPLETION_RATIO": lambda: 1 - C.safe_divide("CNT_INSTALMENT_FUTURE", "CNT_INSTALMENT")},
)
CARD = History(
    "CC",
    [
        "MONTHS_BALANCE",
        "AMT_BALANCE",
        "AMT_CREDIT_LIMIT_ACTUAL",
        "AMT_DRAWINGS_ATM_CURRENT",
        "AMT_DRAWINGS_CURRENT",
        "AMT_DRAWINGS_OTHER_CURRENT",
        "AMT_DRAWINGS_POS_CURRENT",
        "AMT_INST_MIN_REGULARITY",
        "AMT_PAYMENT_CURRENT",
        "AMT_PAYMENT_TOTAL_CURRENT",
        "AMT_RECEIVABLE_PRINCIPAL",
        "AMT_RECIVABLE",
        "AMT_TOTAL_RECEIVABLE",
        "CNT_DRAWINGS_ATM_CURRENT",
        "CNT_DRAWINGS_CURRENT",
        "CNT_DRAWINGS_OTHER_CURRENT",
        "CNT_DRAWINGS_POS_CURRENT",
        "CNT_INSTALMENT_MATURE_CUM",
        "SK_DPD",
        "SK_DPD_DEF",
        "CC_UTILIZATION_RATIO",
        "CC_PAYMENT_MIN_RATIO",
        "CC_DRAWING_LIMIT_RATIO",
    ],
    {"NAME_CONTRACT_STATUS": "CC_STATUS"},
    derived={
        "CC_UTILIZATION_RATIO": lambda: C.safe_divide("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
        "CC_PAYMENT_MIN_RATIO": lambda: C.safe_divide("AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY"),
        "CC_DRAWING_LIMIT_RATIO": lambda: C.safe_divide("AMT_DRAWINGS_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL"),
    },
)
BAD_STATUS = ["1", "2", "3", "4", "5"]


def balance_profile(balance: DataFrame) -> DataFrame:
    """One row per bureau record: month statistics, status counts and rates, number of bad months."""
    wide, found = A.key_profile(
        balance, "SK_ID_BUREAU", "BB", ["MONTHS_BALANCE"], {"STATUS": "BB_STATUS"}, stats=("mean", "max", "min", "count")
    )
    bad = [F.col(f"BB_STATUS_{v}") for v in found["STATUS"] if v in BAD_STATUS]
    total = reduce(lambda a, b: a + b, bad) if bad else F.lit(None).cast("bigint")
    return wide.withColumn("BB_BAD_STATUS_COUNT", total)


def bureau_features(bureau: DataFrame, balance: DataFrame | None = None) -> DataFrame:
    """Bureau history per applicant; the monthly balances are rolled up per record first.

    Records and their balances meet one to one, so the whole upper level is a single ``groupBy``.
    """
    rows = BUREAU.prepare(bureau)
    extra = []
    if balance is not None:
        monthly = balance_profile(balance)
        rows = rows.join(monthly, "SK_ID_BUREAU", "left")
        extra = A.numeric_stats([c for c in monthly.columns if c.startswith("BB_")], "BURO_BAL", ("mean", "max", "sum"))
    categories = {**BUREAU.categories, "CREDIT_CURRENCY": "_CURRENCY"}
    wide, found = A.key_profile(rows, KEY, "BURO", BUREAU.numerics, categories, record_count="BURO_RECORD_COUNT", extra=extra)
    kinds = {"BURO_CREDIT_CURRENCY_NUNIQUE": ("_CURRENCY", "CREDIT_CURRENCY"), "BURO_CREDIT_TYPE_NUNIQUE": ("BURO_TYPE", "CREDIT_TYPE")}
    distinct = {}
    for name, (prefix, column) in kinds.items():
        # The number of distinct values is the number of value counts above zero.
        seen = [f"CAST({A.quoted(n)} > 0 AS BIGINT)" for n in A.level_names(prefix, found.get(column, []))[:-1]]
        distinct[name] = F.expr(" + ".join(seen) or "0L")
    wide = wide.withColumns(distinct)
    return wide.drop(*[c for c in wide.columns if c.startswith("_CURRENCY")])


MONTHS = {6: 180, 12: 365, 24: 730}


def bureau_recent(bureau: DataFrame) -> DataFrame:
    """Active and closed records, and records opened in the last 6, 12 and 24 months."""
    debt, credit = F.col("AMT_CREDIT_SUM_DEBT"), F.col("AMT_CREDIT_SUM")
    active = C.flag(F.col("CREDIT_ACTIVE") == "Active")
    overdue = C.flag(F.col("CREDIT_DAY_OVERDUE") > 0)
    aggs, ratios = [], []
    for state in ("Active", "Closed"):
        is_state = F.coalesce(F.col("CREDIT_ACTIVE") == state, F.lit(False))
        p = f"ADV_BURO_{state.upper()}"
        aggs += [
            A.within(is_state, "count").alias(f"{p}_RECORD_COUNT"),
            A.within(is_state, "sum", debt).alias(f"{p}_DEBT_SUM"),
            A.within(is_state, "sum", credit).alias(f"{p}_CREDIT_SUM"),
        ]
        if state == "Active":
            aggs += [
                A.within(is_state, "max", F.col("AMT_CREDIT_MAX_OVERDUE")).alias(f"{p}_MAX_OVERDUE"),
                A.within(is_state, "max", F.col("CREDIT_DAY_OVERDUE")).alias(f"{p}_MAX_DAYS_OVERDUE"),
            ]
        ratios.append(C.safe_divide(f"{p}_DEBT_SUM", f"{p}_CREDIT_SUM").alias(f"{p}_DEBT_CREDIT_RATIO"))
    for months, days in MONTHS.items():
        recent = F.col("DAYS_CREDIT") >= -days
        p = f"ADV_BURO_LAST_{months}M"
        aggs += [
            A.within(recent, "count").alias(f"{p}_RECORD_COUNT"),
            A.within(recent, "sum", active).alias(f"{p}_ACTIVE_COUNT"),
            A.within(recent, "sum", overdue).alias(f"{p}_OVERDUE_COUNT"),
            A.within(recent, "sum", debt).alias(f"{p}_DEBT_SUM"),
            A.within(recent, "sum", credit).alias(f"{p}_CREDIT_SUM"),
            A.within(recent, "max", F.col("AMT_CREDIT_SUM_OVERDUE")).alias(f"{p}_MAX_OVERDUE"),
        ]
        ratios += [
            C.safe_divide(f"{p}_ACTIVE_COUNT", f"{p}_RECORD_COUNT").alias(f"{p}_ACTIVE_RATIO"),
            C.safe_divide(f"{p}_OVERDUE_COUNT", f"{p}_RECORD_COUNT").alias(f"{p}_OVERDUE_RATIO"),
            C.safe_divide(f"{p}_DEBT_SUM", f"{p}_CREDIT_SUM").alias(f"{p}_DEBT_CREDIT_RATIO"),
        ]
    return bureau.groupBy(KEY).agg(*aggs).select("*", *ratios)


def _recent(df: DataFrame, time: str, windows: dict[int, int], prefix: str, measures, extra=()) -> DataFrame:
    """Measures over nested windows in one pass. Rows older than the widest window never leave the scan."""
    widest = max(windows.values())
    aggs = list(extra)
    for months, bound in windows.items():
        inside = F.col(time) >= -bound
        for name, kind, x in measures:
            aggs.append(A.within(inside, kind, x).alias(f"{prefix}_LAST_{months}M_{name}"))
    return df.filter(F.col(time) >= -widest).groupBy(KEY).agg(*aggs)


def previous_recent(previous: DataFrame) -> DataFrame:
    refused, approved = (C.flag(F.col("NAME_CONTRACT_STATUS") == s) for s in ("Refused", "Approved"))
    return _recent(
        previous,
        "DAYS_DECISION",
        MONTHS,
        "ADV_PREV",
        [
            ("RECORD_COUNT", "count", None),
            ("REFUSED_COUNT", "sum", refused),
            ("APPROVED_COUNT", "sum", approved),
            ("REFUSED_RATE", "mean", refused),
            ("CREDIT_APPLICATION_RATIO_MEAN", "mean", C.safe_divide("AMT_CREDIT", "AMT_APPLICATION")),
            ("CNT_PAYMENT_MEAN", "mean", F.col("CNT_PAYMENT")),
        ],
    )


def instalments_recent(instalments: DataFrame) -> DataFrame:
    delay = DELAY()
    late = C.flag(delay > 0)
    short = C.clip(SHORT().cast("double"), low=0.0)
    return _recent(
        instalments,
        "DAYS_INSTALMENT",
        MONTHS,
        "ADV_INST",
        [
            ("RECORD_COUNT", "count", None),
            ("LATE_RATE", "mean", late),
            ("LATE_COUNT", "sum", late),
            ("LATE_DELAY_MEAN_ONLY", "mean", F.when(delay > 0, delay)),
            ("LATE_DELAY_MAX", "max", delay),
            ("UNDERPAYMENT_RATE", "mean", C.flag(short > 0)),
            ("UNDERPAYMENT_AMOUNT_SUM", "sum", short),
        ],
    )


SAME_MONTHS = {6: 6, 12: 12, 24: 24}


def card_recent(card: DataFrame) -> DataFrame:
    use, month = C.safe_divide("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), F.col("MONTHS_BALANCE")
    trend = A.within(month >= -6, "mean", use) - A.within((month < -6) & (month >= -12), "mean", use)
    return _recent(
        card,
        "MONTHS_BALANCE",
        SAME_MONTHS,
        "ADV_CC",
        [
            ("RECORD_COUNT", "count", None),
            ("UTILIZATION_MEAN", "mean", use),
            ("UTILIZATION_MAX", "max", use),
            ("DPD_RATE", "mean", C.flag(F.col("SK_DPD") > 0)),
            ("DPD_DEF_RATE", "mean", C.flag(F.col("SK_DPD_DEF") > 0)),
            ("DPD_MAX", "max", F.col("SK_DPD")),
        ],
        [trend.alias("ADV_CC_UTILIZATION_LAST6_MINUS_PREV6")],
    )


def pos_recent(pos: DataFrame) -> DataFrame:
    return _recent(
        pos,
        "MONTHS_BALANCE",
        SAME_MONTHS,
        "ADV_POS",
        [
            ("RECORD_COUNT", "count", None),
            ("DPD_RATE", "mean", C.flag(F.col("SK_DPD") > 0)),
            ("DPD_DEF_RATE", "mean", C.flag(F.col("SK_DPD_DEF") > 0)),
            ("DPD_MAX", "max", F.col("SK_DPD")),
            ("COMPLETED_RATE", "mean", C.flag(F.col("NAME_CONTRACT_STATUS") == "Completed")),
        ],
    )



def second_order(bureau: DataFrame, card: DataFrame, instalments: DataFrame, previous: DataFrame, pos: DataFrame) -> DataFrame:
    """Comparisons of recent windows with each other: ratios, trends, accelerations, a decayed rate."""
    day = F.col("DAYS_CREDIT")
    overdue = F.col("AMT_CREDIT_SUM_OVERDUE")
    a = bureau.groupBy(KEY).agg(
        C.safe_divide(A.within(day >= -180, "sum", overdue), A.within(day >= -730, "sum", overdue)).alias(
            "SO_BURO_OVERDUE_SUM_6M_TO_24M_RATIO"
        )
    )
    month, use = F.col("MONTHS_BALANCE"), C.safe_divide("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL")
    b = card.groupBy(KEY).agg(
        (A.within(month >= -6, "mean", use) - A.within((month < -6) & (month >= -12), "mean", use)).alias(
            "SO_CC_UTILIZATION_CURRENT6_MINUS_PRIOR6"
        )
    )
    late = C.flag(DELAY() > 0)
    r = {m: A.within(F.col("DAYS_INSTALMENT") >= -d, "mean", late) for m, d in (("3", 90), ("6", 180), ("12", 365))}
    c = instalments.groupBy(KEY).agg(
        (r["3"] - r["6"]).alias("SO_INST_LATE_RATE_3M_MINUS_6M"), (r["6"] - r["12"]).alias("SO_INST_LATE_RATE_6M_MINUS_12M")
    )
    c = c.withColumn(
        "SO_INST_LATE_RATE_ACCEL_3_6_12M", F.col("SO_INST_LATE_RATE_3M_MINUS_6M") - F.col("SO_INST_LATE_RATE_6M_MINUS_12M")
    )
    weight = F.exp(-C.clip(-F.col("DAYS_DECISION") / 30.0, low=0.0) / 12.0)
    refused = C.flag(F.col("NAME_CONTRACT_STATUS") == "Refused")
    d = previous.groupBy(KEY).agg(
        C.safe_divide(F.sum(refused * weight), F.sum(weight)).alias("SO_PREV_RECENCY_WEIGHTED_REFUSAL_RATE")
    )
    aggs = []
    for name, column in (("DPD", "SK_DPD"), ("DPD_DEF", "SK_DPD_DEF")):
        hit = C.flag(F.col(column) > 0)
        w = {m: A.within(F.col("MONTHS_BALANCE") >= -m, "mean", hit) for m in (3, 6, 12)}
        aggs += [
            (w[3] - w[6]).alias(f"SO_POS_{name}_RATE_3M_MINUS_6M"),
            (w[6] - w[12]).alias(f"SO_POS_{name}_RATE_6M_MINUS_12M"),
        ]
    e = pos.groupBy(KEY).agg(*aggs)
    e = e.withColumn("SO_POS_DPD_RATE_ACCEL_3_6_12M", F.col("SO_POS_DPD_RATE_3M_MINUS_6M") - F.col("SO_POS_DPD_RATE_6M_MINUS_12M"))
    out = reduce(lambda x, y: x.join(y, KEY, "full"), [a, b, c, d, e])
    return C.finite_columns(out)


ENCODED_PREVIOUS = ["PRODUCT_COMBINATION", "NAME_GOODS_CATEGORY", "NAME_CASH_LOAN_PURPOSE"]


def previous_categories(previous: DataFrame, columns=tuple(ENCODED_PREVIOUS)) -> DataFrame:
    """The most recent and the most frequent non-null category of every applicant."""
    recent = previous.groupBy(KEY).agg(
        *[A.most_recent(c, F.struct(F.col("DAYS_DECISION"), F.col(c))).alias(f"CAT_PREV_RECENT_{c}") for c in columns]
    )
    # One pass for all columns: (column, value) counts, then the best value of each column.
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = previous.select(KEY, F.inline(pairs)).filter("v is not null").groupBy(KEY, "c", "v").agg(F.count(F.lit(1)).alias("n"))
    best = lambda c: F.min_by("v", F.when(F.col("c") == c, F.struct(-F.col("n"), F.col("v"))))
    modal = counts.groupBy(KEY).agg(*[best(c).alias(f"CAT_PREV_MODE_{c}") for c in columns])
    return recent.join(modal, KEY, "left")


def joined_matrix(base: DataFrame, groups: list[DataFrame], keep: list[str] | None = None) -> DataFrame:
    """All rows of ``base`` with the feature groups beside them; optionally only the listed columns that exist."""
    wide = C.first_of_each_name([base, *groups], KEY)
    return wide.select(KEY, *[c for c in C.present(wide, keep) if c != KEY]) if keep else wide
