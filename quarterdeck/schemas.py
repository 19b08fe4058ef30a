"""Table contracts: managed-table column lists, type overrides and document schemas.

Statement line items are DOUBLE unless listed in a BIGINT override; profile
attributes carry explicit types. Column names are the cleaned header names
(see :func:`quarterdeck.functions.clean_name`).
"""

from __future__ import annotations

from pyspark.sql import types as T

from quarterdeck.functions.coerce import clean_name

KEYS = ("ticker", "report_date")

# Managed balance sheet columns after the keys, in table order.
MANAGED_BALANCE_COLUMNS = """
Treasury_Shares_Number Ordinary_Shares_Number Share_Issued Net_Debt Total_Debt Tangible_Book_Value Invested_Capital
Working_Capital Net_Tangible_Assets Capital_Lease_Obligations Common_Stock_Equity Total_Capitalization
Total_Equity_Gross_Minority_Interest Stockholders_Equity Gains_Losses_Not_Affecting_Retained_Earnings
Other_Equity_Adjustments Retained_Earnings Capital_Stock Common_Stock Total_Liabilities_Net_Minority_Interest
Total_Non_Current_Liabilities_Net_Minority_Interest Other_Non_Current_Liabilities Tradeand_Other_Payables_Non_Current
Long_Term_Debt_And_Capital_Lease_Obligation Long_Term_Capital_Lease_Obligation Long_Term_Debt Current_Liabilities
Other_Current_Liabilities Current_Deferred_Liabilities Current_Deferred_Revenue Current_Debt_And_Capital_Lease_Obligation
Current_Capital_Lease_Obligation Current_Debt Other_Current_Borrowings Commercial_Paper Payables_And_Accrued_Expenses
Current_Accrued_Expenses Payables Total_Tax_Payable Income_Tax_Payable Accounts_Payable Total_Assets
Total_Non_Current_Assets Other_Non_Current_Assets Non_Current_Deferred_Assets Non_Current_Deferred_Taxes_Assets
Investments_And_Advances Other_Investments Investmentin_Financial_Assets Available_For_Sale_Securities Net_PPE
Accumulated_Depreciation Gross_PPE Leases Other_Properties Machinery_Furniture_Equipment Land_And_Improvements Properties
Current_Assets Other_Current_Assets Inventory Receivables Other_Receivables Accounts_Receivable
Cash_Cash_Equivalents_And_Short_Term_Investments Other_Short_Term_Investments Cash_And_Cash_Equivalents Cash_Equivalents
Cash_Financial Other_Intangible_Assets Finished_Goods Goodwill_And_Other_Intangible_Assets Goodwill
Long_Term_Equity_Investment Allowance_For_Doubtful_Accounts_Receivable
Pensionand_Other_Post_Retirement_Benefit_Plans_Current Buildings_And_Improvements Hedging_Assets_Current
Non_Current_Deferred_Taxes_Liabilities Raw_Materials Non_Current_Deferred_Revenue Gross_Accounts_Receivable
Work_In_Process Non_Current_Deferred_Liabilities Financial_Assets
""".split()

# Managed income statement columns after the keys, in table order.
MANAGED_INCOME_COLUMNS = """
Tax_Effect_Of_Unusual_Items Tax_Rate_For_Calcs Normalized_EBITDA Net_Income_From_Continuing_Operation_Net_Minority_Interest
Reconciled_Depreciation Reconciled_Cost_Of_Revenue EBITDA EBIT Net_Interest_Income Interest_Expense Interest_Income
Normalized_Income Net_Income_From_Continuing_And_Discontinued_Operation Total_Expenses Total_Operating_Income_As_Reported
Diluted_Average_Shares Basic_Average_Shares Diluted_EPS Basic_EPS Diluted_NI_Availto_Com_Stockholders
Net_Income_Common_Stockholders Net_Income Net_Income_Including_Noncontrolling_Interests Net_Income_Continuous_Operations
Tax_Provision Pretax_Income Other_Income_Expense Other_Non_Operating_Income_Expenses
Net_Non_Operating_Interest_Income_Expense Interest_Expense_Non_Operating Interest_Income_Non_Operating Operating_Income
Operating_Expense Research_And_Development Selling_General_And_Administration Gross_Profit Cost_Of_Revenue Total_Revenue
Operating_Revenue Total_Unusual_Items_Excluding_Goodwill Write_Off Total_Unusual_Items Gain_On_Sale_Of_Security
Other_Gand_A General_And_Administrative_Expense Special_Income_Charges Selling_And_Marketing_Expense
""".split()

# Statement items stored as BIGINT (share counts); every other item is DOUBLE.
LONG_ITEMS = {
    "balance_sheet": ("Treasury_Shares_Number", "Ordinary_Shares_Number", "Share_Issued"),
    "income_statement": ("Diluted_Average_Shares", "Basic_Average_Shares"),
    "cash_flow_statement": (),
}

# Profile attributes kept by the managed profile table (source name, type, managed name).
PROFILE_ATTRIBUTES = [
    ("displayName", "string", "company"),
    ("address1", "string", "address"),
    ("city", "string", "city"),
    ("state", "string", "state"),
    ("zip", "string", "zip"),
    ("country", "string", "country"),
    ("industry", "string", "industry"),
    ("sector", "string", "sector"),
    ("longBusinessSummary", "string", "longBusinessSummary"),
    ("fullTimeEmployees", "bigint", "fullTimeEmployees"),
    ("marketCap", "bigint", "marketCap"),
    ("enterpriseValue", "bigint", "enterpriseValue"),
    ("profitMargins", "double", "profitMargins"),
    ("sharesOutstanding", "bigint", "sharesOutstanding"),
    ("totalRevenue", "bigint", "totalRevenue"),
    ("debtToEquity", "double", "debtToEquity"),
    ("returnOnAssets", "double", "returnOnAssets"),
    ("returnOnEquity", "double", "returnOnEquity"),
    ("grossProfits", "bigint", "grossProfits"),
    ("freeCashflow", "bigint", "freeCashflow"),
    ("operatingCashflow", "bigint", "operatingCashflow"),
    ("revenueGrowth", "double", "revenueGrowth"),
    ("ebitda", "bigint", "ebitda"),
    ("totalDebt", "bigint", "totalDebt"),
    ("currentRatio", "double", "currentRatio"),
    ("quickRatio", "double", "quickRatio"),
]

SECTIONS = ("balance_sheet", "income_statement", "cash_flow_statement")
# Quarterly sections as the first provider names them, with the statement each belongs to. They
# have the same shape; the long form tags rows with a period. The names after them are read as well.
QUARTERLY_STATEMENTS = {
    "quarterly_balance_sheet": "balance_sheet",
    "quarterly_financials": "income_statement",
    "quarterly_cashflow": "cash_flow_statement",
    "quarterly_income_statement": "income_statement",
    "quarterly_cash_flow_statement": "cash_flow_statement",
}
QUARTERLY_SECTIONS = tuple(QUARTERLY_STATEMENTS)
# Further sections of the two providers, shaped like the statements beside them.
MAP_EXTRAS = ("earnings",)
RECORD_EXTRAS = ("ratios", "cash_flow_ratios", "profile")

_ITEM_MAP = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))

# Company document, map shape: each statement is {line item: {date: value}}, "" marks a missing value.
MAP_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("company_info", T.MapType(T.StringType(), T.StringType())),
        *[T.StructField(s, _ITEM_MAP) for s in MAP_EXTRAS + SECTIONS + QUARTERLY_SECTIONS],
    ]
)

_RECORDS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

# Company document, record shape: each section is a list of records with "date" and "calendarYear".
RECORD_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("error", T.StringType()),
        *[T.StructField(s, _RECORDS) for s in RECORD_EXTRAS + SECTIONS],
    ]
)


# Types in the second provider's profile records; its other attributes are text.
PROFILE_RECORD_TYPES = {
    "Full_Time_Employees": "bigint",
    "Full_time_Employees": "bigint",
    "Market_Cap": "double",
    "Market_Capitalization": "double",
    "Revenue_Per_Share": "double",
    "Profit_Margin": "double",
    "Payout_Ratio": "double",
    "Return_On_Equity": "double",
    "Return_On_Assets": "double",
    "Debt_To_Equity": "double",
    "Current_Ratio": "double",
    "Quick_Ratio": "double",
    "Book_Value": "double",
    "Audit_Risk": "bigint",
    "Board_Risk": "bigint",
    "Compensation_Risk": "bigint",
    "Shareholder_Rights_Risk": "bigint",
    "Overall_Risk": "bigint",
}


def item_type(section: str, item: str) -> str:
    if section == "profile":
        return PROFILE_RECORD_TYPES.get(item, "string")
    base = QUARTERLY_STATEMENTS.get(section, section)
    return "bigint" if item in LONG_ITEMS.get(base, ()) else "double"


# All attributes of a company profile with their types, in the provider's order.
FULL_PROFILE = """
address1 string
city string
state string
zip string
country string
phone string
website string
industry string
industryKey string
industryDisp string
sector string
sectorKey string
sectorDisp string
longBusinessSummary string
fullTimeEmployees bigint
auditRisk bigint
boardRisk bigint
compensationRisk bigint
shareHolderRightsRisk bigint
overallRisk bigint
governanceEpochDate bigint
compensationAsOfEpochDate bigint
irWebsite string
executiveTeam string
maxAge bigint
priceHint bigint
previousClose double
open double
dayLow double
dayHigh double
regularMarketPreviousClose double
regularMarketOpen double
regularMarketDayLow double
regularMarketDayHigh double
dividendRate double
dividendYield double
exDividendDate bigint
payoutRatio double
fiveYearAvgDividendYield double
beta double
trailingPE double
forwardPE double
volume bigint
regularMarketVolume bigint
averageVolume bigint
averageVolume10days bigint
averageDailyVolume10Day bigint
bid double
ask double
bidSize bigint
askSize bigint
marketCap bigint
nonDilutedMarketCap bigint
fiftyTwoWeekLow double
fiftyTwoWeekHigh double
allTimeHigh double
allTimeLow double
priceToSalesTrailing12Months double
fiftyDayAverage double
twoHundredDayAverage double
trailingAnnualDividendRate double
trailingAnnualDividendYield double
currency string
tradeable boolean
enterpriseValue bigint
profitMargins double
floatShares bigint
sharesOutstanding bigint
sharesShort bigint
sharesShortPriorMonth bigint
sharesShortPreviousMonthDate bigint
dateShortInterest bigint
sharesPercentSharesOut double
heldPercentInsiders double
heldPercentInstitutions double
shortRatio double
shortPercentOfFloat double
impliedSharesOutstanding bigint
bookValue double
priceToBook double
lastFiscalYearEnd bigint
nextFiscalYearEnd bigint
mostRecentQuarter bigint
earningsQuarterlyGrowth double
netIncomeToCommon bigint
trailingEps double
forwardEps double
lastSplitFactor string
lastSplitDate bigint
enterpriseToRevenue double
enterpriseToEbitda double
52WeekChange double
SandP52WeekChange double
lastDividendValue double
lastDividendDate bigint
quoteType string
currentPrice double
targetHighPrice double
targetLowPrice double
targetMeanPrice double
targetMedianPrice double
recommendationMean double
recommendationKey string
numberOfAnalystOpinions bigint
totalCash bigint
totalCashPerShare double
ebitda bigint
totalDebt bigint
quickRatio double
currentRatio double
totalRevenue bigint
debtToEquity double
revenuePerShare double
returnOnAssets double
returnOnEquity double
grossProfits bigint
freeCashflow bigint
operatingCashflow bigint
earningsGrowth double
revenueGrowth double
grossMargins double
ebitdaMargins double
operatingMargins double
financialCurrency string
symbol string
language string
region string
typeDisp string
quoteSourceName string
triggerable boolean
customPriceAlertConfidence string
postMarketTime bigint
regularMarketTime bigint
exchange string
messageBoardId string
exchangeTimezoneName string
exchangeTimezoneShortName string
gmtOffSetMilliseconds bigint
market string
esgPopulated boolean
regularMarketChangePercent double
regularMarketPrice double
cryptoTradeable boolean
earningsTimestamp bigint
earningsTimestampStart bigint
earningsTimestampEnd bigint
earningsCallTimestampStart bigint
earningsCallTimestampEnd bigint
isEarningsDateEstimate boolean
epsTrailingTwelveMonths double
epsForward double
epsCurrentYear double
priceEpsCurrentYear double
fiftyDayAverageChange double
fiftyDayAverageChangePercent double
twoHundredDayAverageChange double
twoHundredDayAverageChangePercent double
sourceInterval bigint
exchangeDataDelayedBy bigint
averageAnalystRating string
hasPrePostMarketData boolean
firstTradeDateMilliseconds bigint
postMarketChangePercent double
postMarketPrice double
postMarketChange double
regularMarketChange double
regularMarketDayRange string
fullExchangeName string
averageDailyVolume3Month bigint
fiftyTwoWeekLowChange double
fiftyTwoWeekLowChangePercent double
fiftyTwoWeekRange string
fiftyTwoWeekHighChange double
fiftyTwoWeekHighChangePercent double
fiftyTwoWeekChangePercent double
dividendDate bigint
shortName string
longName string
corporateActions string
marketState string
displayName string
trailingPegRatio double
"""

#: (attribute, type, column name) of the full profile.
FULL_PROFILE_ATTRIBUTES = [(n, t, clean_name(n)) for n, t in (line.split() for line in FULL_PROFILE.strip().splitlines())]
