"""The credit tables, derived from the test tables, as expressions both SQL dialects read.

Amounts are whole numbers or binary fractions, so their sums are exact in any order.
``{days:x}`` stands for the day offset of a timestamp before 2001-12-31, ``{month:x}`` for the month offset.
"""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

APPLICATION = """
c_custkey AS SK_ID_CURR
CASE WHEN c_custkey % 50 = 0 THEN 0e0 ELSE floor(c_acctbal) + 1000 END AS AMT_INCOME_TOTAL
20000e0 + c_custkey * 7919 % 100000 AS AMT_CREDIT
nullif(500e0 + c_custkey * 31 % 3000, 500e0) AS AMT_ANNUITY
18000e0 + c_custkey * 6007 % 90000 AS AMT_GOODS_PRICE
-(7000 + c_custkey * 17 % 18000) AS DAYS_BIRTH
CASE WHEN c_custkey % 9 = 0 THEN 365243 ELSE -(c_custkey * 13 % 6000) END AS DAYS_EMPLOYED
-(c_custkey * 11 % 9000) AS DAYS_REGISTRATION
-(c_custkey * 5 % 5000) AS DAYS_ID_PUBLISH
-(c_custkey * 3 % 3000) AS DAYS_LAST_PHONE_CHANGE
c_custkey % 4 AS CNT_CHILDREN
nullif(c_custkey % 6, 5) AS CNT_FAM_MEMBERS
CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER
nullif(c_custkey % 10, 0) / 10e0 AS EXT_SOURCE_1
nullif(c_custkey % 7, 3) / 7e0 AS EXT_SOURCE_2
nullif(c_nationkey % 5, 4) / 5e0 AS EXT_SOURCE_3
c_custkey % 2 AS FLAG_MOBIL
nullif(c_custkey % 3, 2) AS FLAG_EMP_PHONE
c_custkey % 5 AS FLAG_WORK_PHONE
1 AS FLAG_CONT_MOBILE
c_custkey % 2 AS FLAG_PHONE
0 AS FLAG_EMAIL
c_custkey % 2 AS REG_REGION_NOT_LIVE_REGION
c_custkey % 3 AS REG_REGION_NOT_WORK_REGION
0 AS LIVE_REGION_NOT_WORK_REGION
c_nationkey % 2 AS REG_CITY_NOT_LIVE_CITY
nullif(c_nationkey % 3, 1) AS REG_CITY_NOT_WORK_CITY
1 AS LIVE_CITY_NOT_WORK_CITY
c_nationkey % 3 AS REGION_RATING_CLIENT
nullif(c_nationkey % 4, 3) AS REGION_RATING_CLIENT_W_CITY
CASE c_custkey % 8 WHEN 0 THEN 'MONDAY' WHEN 1 THEN 'SATURDAY' WHEN 2 THEN 'SUNDAY' WHEN 3 THEN NULL ELSE 'FRIDAY' END AS WEEKDAY_APPR_PROCESS_START
nullif(c_custkey % 25, 24) AS HOUR_APPR_PROCESS_START
c_custkey % 2 AS FLAG_DOCUMENT_2
nullif(c_custkey % 3, 0) AS FLAG_DOCUMENT_3
nullif(c_custkey % 4, 0) AS OBS_30_CNT_SOCIAL_CIRCLE
c_custkey % 3 AS DEF_30_CNT_SOCIAL_CIRCLE
c_custkey % 5 AS OBS_60_CNT_SOCIAL_CIRCLE
nullif(c_custkey % 3, 1) AS DEF_60_CNT_SOCIAL_CIRCLE
nullif(c_custkey % 4, 3) AS AMT_REQ_CREDIT_BUREAU_HOUR
nullif(c_custkey % 4, 3) * 2 AS AMT_REQ_CREDIT_BUREAU_DAY
nullif(c_custkey % 4, 3) + 1 AS AMT_REQ_CREDIT_BUREAU_WEEK
nullif(c_custkey % 4, 3) + 2 AS AMT_REQ_CREDIT_BUREAU_MON
nullif(c_custkey % 8, 7) AS AMT_REQ_CREDIT_BUREAU_QRT
nullif(c_custkey % 12, 11) AS AMT_REQ_CREDIT_BUREAU_YEAR
nullif(c_custkey % 5, 0) / 5e0 AS APARTMENTS_AVG
nullif(c_custkey % 10, 5) / 10e0 AS FLOORSMAX_MODE
nullif(c_custkey % 15, 5) / 15e0 AS LIVINGAREA_MEDI
c_mktsegment AS HOUSETYPE_MODE
CASE WHEN c_nationkey % 6 = 5 THEN NULL ELSE c_mktsegment END AS ORGANIZATION_TYPE
CASE c_nationkey % 7 WHEN 0 THEN 'Managers' WHEN 1 THEN 'Drivers' WHEN 2 THEN NULL ELSE 'Laborers' END AS OCCUPATION_TYPE
"""

BUREAU = """
o_custkey AS SK_ID_CURR
o_orderkey AS SK_ID_BUREAU
CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' END AS CREDIT_ACTIVE
CASE o_orderkey % 5 WHEN 0 THEN 'currency 2' WHEN 1 THEN NULL ELSE 'currency 1' END AS CREDIT_CURRENCY
{days:o_orderdate} AS DAYS_CREDIT
nullif(greatest(o_orderkey % 40 - 30, 0), 5) AS CREDIT_DAY_OVERDUE
CASE WHEN o_orderkey % 11 > 0 THEN {days:o_orderdate} + o_orderkey % 900 END AS DAYS_CREDIT_ENDDATE
{days:o_orderdate} + o_orderkey % 300 AS DAYS_ENDDATE_FACT
nullif(o_orderkey % 500, 0) * 1e0 AS AMT_CREDIT_MAX_OVERDUE
o_orderkey % 3 AS CNT_CREDIT_PROLONG
CASE WHEN o_orderkey % 37 = 0 THEN 0e0 ELSE floor(o_totalprice) END AS AMT_CREDIT_SUM
CASE WHEN o_orderkey % 6 > 0 THEN floor(o_totalprice) * (o_orderkey % 8) / 8e0 END AS AMT_CREDIT_SUM_DEBT
CASE WHEN o_orderkey % 4 = 0 THEN floor(o_totalprice) / 2e0 END AS AMT_CREDIT_SUM_LIMIT
greatest(o_orderkey % 100 - 60, 0) * 10e0 AS AMT_CREDIT_SUM_OVERDUE
o_orderpriority AS CREDIT_TYPE
{days:o_orderdate} + 30 AS DAYS_CREDIT_UPDATE
CASE WHEN o_orderkey % 5 > 0 THEN floor(o_totalprice) / 16e0 END AS AMT_ANNUITY
"""

BALANCE = """
l_orderkey AS SK_ID_BUREAU
-(l_linenumber + l_partkey % 24) AS MONTHS_BALANCE
CASE l_partkey % 9 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '5' WHEN 5 THEN NULL WHEN 6 THEN 'X' ELSE 'C' END AS STATUS
"""

PREVIOUS = """
o_custkey AS SK_ID_CURR
floor(o_totalprice) / 32e0 AS AMT_ANNUITY
CASE WHEN o_orderkey % 19 = 0 THEN 0e0 ELSE floor(o_totalprice) END AS AMT_APPLICATION
floor(o_totalprice) + (o_orderkey % 7) * 512e0 AS AMT_CREDIT
CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) / 8e0 END AS AMT_DOWN_PAYMENT
floor(o_totalprice) - 100 AS AMT_GOODS_PRICE
o_orderkey % 24 AS HOUR_APPR_PROCESS_START
o_orderkey % 2 AS NFLAG_LAST_APPL_IN_DAY
CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 16) / 16e0 END AS RATE_DOWN_PAYMENT
CASE WHEN o_orderkey % 29 = 0 THEN 0.25e0 END AS RATE_INTEREST_PRIMARY
CASE WHEN o_orderkey % 31 = 0 THEN 0.75e0 END AS RATE_INTEREST_PRIVILEGED
{days:o_orderdate} AS DAYS_DECISION
o_orderkey % 1000 AS SELLERPLACE_AREA
CASE WHEN o_orderkey % 6 > 0 THEN o_orderkey % 6 * 12 END AS CNT_PAYMENT
CASE WHEN o_orderkey % 3 = 0 THEN 365243 ELSE {days:o_orderdate} + 5 END AS DAYS_FIRST_DRAWING
CASE WHEN o_orderkey % 13 = 0 THEN 365243 ELSE {days:o_orderdate} + 30 END AS DAYS_FIRST_DUE
{days:o_orderdate} + 400 AS DAYS_LAST_DUE_1ST_VERSION
CASE WHEN o_orderkey % 4 = 0 THEN 365243 ELSE {days:o_orderdate} + 300 END AS DAYS_LAST_DUE
CASE WHEN o_orderkey % 5 = 0 THEN 365243 ELSE {days:o_orderdate} + 310 END AS DAYS_TERMINATION
o_orderkey % 2 AS NFLAG_INSURED_ON_APPROVAL
CASE o_orderkey % 3 WHEN 0 THEN 'Cash loans' WHEN 1 THEN 'Consumer loans' ELSE 'Revolving loans' END AS NAME_CONTRACT_TYPE
CASE o_orderkey % 7 WHEN 0 THEN 'MONDAY' WHEN 1 THEN 'SUNDAY' ELSE 'FRIDAY' END AS WEEKDAY_APPR_PROCESS_START
CASE WHEN o_orderkey % 20 = 0 THEN 'N' ELSE 'Y' END AS FLAG_LAST_APPL_PER_CONTRACT
CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'Repairs' ELSE 'Urgent needs' END AS NAME_CASH_LOAN_PURPOSE
CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS
CASE WHEN o_orderkey % 2 = 0 THEN 'Cash' ELSE 'Bank' END AS NAME_PAYMENT_TYPE
CASE WHEN o_orderstatus = 'O' THEN 'LIMIT' ELSE 'XAP' END AS CODE_REJECT_REASON
CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Family' ELSE 'Alone' END AS NAME_TYPE_SUITE
CASE WHEN o_orderkey % 5 = 0 THEN 'New' ELSE 'Repeater' END AS NAME_CLIENT_TYPE
nullif(o_orderpriority, '5-LOW') AS NAME_GOODS_CATEGORY
CASE WHEN o_orderkey % 3 = 0 THEN 'POS' ELSE 'Cash' END AS NAME_PORTFOLIO
CASE WHEN o_orderkey % 2 = 0 THEN 'walk-in' ELSE 'x-sell' END AS NAME_PRODUCT_TYPE
CASE o_orderkey % 4 WHEN 0 THEN 'Stone' WHEN 1 THEN 'Country-wide' ELSE 'Contact center' END AS CHANNEL_TYPE
CASE WHEN o_orderkey % 2 = 0 THEN 'Clothing' ELSE 'Furniture' END AS NAME_SELLER_INDUSTRY
CASE o_orderkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'middle' ELSE NULL END AS NAME_YIELD_GROUP
concat(o_orderpriority, ' ', o_orderstatus) AS PRODUCT_COMBINATION
"""

INSTALMENTS = """
o_custkey AS SK_ID_CURR
l_linenumber % 2 AS NUM_INSTALMENT_VERSION
l_linenumber AS NUM_INSTALMENT_NUMBER
{days:o_orderdate} AS DAYS_INSTALMENT
CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE {days:o_orderdate} + l_partkey % 60 - 40 END AS DAYS_ENTRY_PAYMENT
CASE WHEN l_partkey % 41 = 0 THEN 0e0 ELSE l_quantity * 64 END AS AMT_INSTALMENT
CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_quantity * (60 + l_partkey % 8) END AS AMT_PAYMENT
"""

POS = """
o_custkey AS SK_ID_CURR
{month:l_shipdate} AS MONTHS_BALANCE
CASE WHEN l_partkey % 12 > 0 THEN l_partkey % 12 * 2 ELSE 0 END AS CNT_INSTALMENT
CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_partkey % 12 END AS CNT_INSTALMENT_FUTURE
CASE l_returnflag WHEN 'R' THEN 'Completed' WHEN 'A' THEN 'Active' ELSE 'Signed' END AS NAME_CONTRACT_STATUS
nullif(greatest(l_partkey % 20 - 15, 0), 4) AS SK_DPD
greatest(l_partkey % 30 - 28, 0) AS SK_DPD_DEF
"""

CARD = """
o_custkey AS SK_ID_CURR
{month:l_shipdate} AS MONTHS_BALANCE
l_quantity * 128 AS AMT_BALANCE
CASE WHEN l_suppkey % 9 = 0 THEN 0e0 ELSE 4096e0 + l_suppkey % 5 * 1024 END AS AMT_CREDIT_LIMIT_ACTUAL
CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity * 4 END AS AMT_DRAWINGS_ATM_CURRENT
l_quantity * 16 AS AMT_DRAWINGS_CURRENT
CASE WHEN l_partkey % 7 = 0 THEN l_quantity * 1 END AS AMT_DRAWINGS_OTHER_CURRENT
l_quantity * 8 AS AMT_DRAWINGS_POS_CURRENT
CASE WHEN l_partkey % 11 = 0 THEN 0e0 ELSE l_quantity * 2 END AS AMT_INST_MIN_REGULARITY
l_quantity * 3 AS AMT_PAYMENT_CURRENT
l_quantity * (l_partkey % 4) AS AMT_PAYMENT_TOTAL_CURRENT
l_quantity * 100 AS AMT_RECEIVABLE_PRINCIPAL
l_quantity * 101 AS AMT_RECIVABLE
l_quantity * 102 AS AMT_TOTAL_RECEIVABLE
nullif(l_partkey % 6, 5) AS CNT_DRAWINGS_ATM_CURRENT
l_partkey % 9 AS CNT_DRAWINGS_CURRENT
nullif(l_partkey % 2, 1) AS CNT_DRAWINGS_OTHER_CURRENT
l_partkey % 5 AS CNT_DRAWINGS_POS_CURRENT
l_linenumber * 2 AS CNT_INSTALMENT_MATURE_CUM
CASE l_linestatus WHEN 'F' THEN 'Completed' ELSE 'Active' END AS NAME_CONTRACT_STATUS
greatest(l_partkey % 25 - 20, 0) AS SK_DPD
nullif(greatest(l_partkey % 25 - 23, 0), 0) AS SK_DPD_DEF
"""

TARGET = "CASE WHEN sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 3 > count(*) THEN 1 ELSE 0 END"
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def _exprs(text: str, dialect: str) -> list[str]:
    day = "datediff({0}, DATE '2001-12-31')" if dialect == "spark" else "date_diff('day', DATE '2001-12-31', CAST({0} AS DATE))"
    month = "(year({0}) * 12 + month({0}) - 24024)"
    text = re.sub(r"\{days:(\w+)\}", lambda m: day.format(m.group(1)), text)
    text = re.sub(r"\{month:(\w+)\}", lambda m: month.format(m.group(1)), text)
    return [line for line in text.strip().splitlines()]


def as_sql(text: str, source: str) -> str:
    return f"SELECT {', '.join(_exprs(text, 'sql'))} FROM {source}"


SQL = {
    "app": as_sql(APPLICATION, "customer"),
    "bureau": as_sql(BUREAU, "orders"),
    "balance": as_sql(BALANCE, "lineitem"),
    "prev": as_sql(PREVIOUS, "orders"),
    "inst": as_sql(INSTALMENTS, LINES),
    "pos": as_sql(POS, LINES),
    "card": as_sql(CARD, LINES),
    "target": f"SELECT c_custkey AS SK_ID_CURR, coalesce(y, 0) AS TARGET, (c_custkey % 2147483647) * 48271 % 2147483647 % 3 AS fold FROM customer LEFT JOIN (SELECT o_custkey, {TARGET} AS y FROM orders GROUP BY 1) ON o_custkey = c_custkey",
}


def _lines(t) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def application(t) -> DataFrame:
    return t.customer.selectExpr(*_exprs(APPLICATION, "spark"))


def bureau(t) -> DataFrame:
    return t.orders.selectExpr(*_exprs(BUREAU, "spark"))


def balance(t) -> DataFrame:
    return t.lineitem.selectExpr(*_exprs(BALANCE, "spark"))


def previous(t) -> DataFrame:
    return t.orders.selectExpr(*_exprs(PREVIOUS, "spark"))


def instalments(t) -> DataFrame:
    return _lines(t).selectExpr(*_exprs(INSTALMENTS, "spark"))


def pos(t) -> DataFrame:
    return _lines(t).selectExpr(*_exprs(POS, "spark"))


def card(t) -> DataFrame:
    return _lines(t).selectExpr(*_exprs(CARD, "spark"))


def targets(t) -> DataFrame:
    """(SK_ID_CURR, TARGET, fold): the label and a hashed fold number of every customer."""
    y = t.orders.groupBy("o_custkey").agg(F.expr(TARGET).alias("y"))
    ids = t.customer.select("c_custkey")
    return ids.join(y, F.col("c_custkey") == F.col("o_custkey"), "left").selectExpr(
        "c_custkey AS SK_ID_CURR", "coalesce(y, 0) AS TARGET", "(c_custkey % 2147483647) * 48271 % 2147483647 % 3 AS fold"
    )
