"""Target schemas of the staged datasets and of the raw macro file."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
INT, LONG, TEXT, DOUBLE = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()


def _schema(required: str = "", **fields: T.DataType) -> T.StructType:
    must = set(required.split())
    return T.StructType([T.StructField(n, t, n not in must) for n, t in fields.items()])


LOAN = _schema(
    "CustomerID LoanID Age EmploymentStatus HomeOwnershipStatus MaritalStatus PreviousLoanDefault AnnualIncome TotalAssets "
    "TotalLiabilities LoanType LoanDate LoanAmount LoanDurationMonths InterestRate DelayedPayments Balance MonthlyPayment "
    "PaymentStatus AccountID AccountType PaymentBehavior",
    CustomerID=LONG, LoanID=TEXT, Age=INT, JobTitle=TEXT, EmploymentStatus=INT, HomeOwnershipStatus=TEXT,
    MaritalStatus=TEXT, PreviousLoanDefault=INT, AnnualIncome=MONEY, TotalAssets=MONEY, TotalLiabilities=MONEY,
    AnnualExpenses=MONEY, MonthlySavings=MONEY, AnnualBonus=MONEY, DebtToIncomeRatio=MONEY, PaymentHistoryYears=INT,
    JobTenureMonths=INT, NumDependents=INT, LoanType=TEXT, LoanDate=T.DateType(), LoanAmount=MONEY,
    LoanDurationMonths=INT, InterestRate=MONEY, DelayedPayments=INT, Balance=MONEY, MonthlyPayment=MONEY,
    LoanToValueRatio=MONEY, PaymentStatus=TEXT, AccountID=TEXT, AccountType=TEXT, PaymentBehavior=TEXT,
    AccountBalance=MONEY, CreditScore=INT, NumBankAccounts=INT, NumCreditCards=INT, NumLoans=INT,
    NumCreditInquiries=INT, CreditUtilizationRatio=MONEY, CreditHistoryLengthMonths=INT, CreditMixRatio=MONEY,
)

FRAUD = _schema(
    "TransactionID CustomerID TransactionDate TransactionTypeName",
    TransactionID=LONG, CustomerID=LONG, TransactionDate=T.TimestampType(), TransactionTypeName=TEXT,
    DistanceFromHome=DOUBLE, DistanceFromLastTransaction=DOUBLE, RatioToMedianTransactionAmount=DOUBLE,
    IsOnlineTransaction=INT, IsUsedChip=INT, IsUsedPIN=INT, IsFraudulent=INT,
)

MARKET = _schema(
    "MarketDate MarketName OpenValue CloseValue",
    MarketDate=T.DateType(), MarketName=TEXT, OpenValue=MONEY, CloseValue=MONEY, HighestValue=MONEY, LowestValue=MONEY,
    Volume=MONEY, InterestRate=DOUBLE, ExchangeRate=DOUBLE, GoldPrice=MONEY, OilPrice=MONEY, VIX=DOUBLE,
    TEDSpread=DOUBLE, EFFR=DOUBLE,
)

MACRO = _schema(
    "ReportDate CountryName UnemploymentRate GDP DebtRatio DeficitRatio InflationRate",
    ReportDate=T.DateType(), CountryName=TEXT, UnemploymentRate=MONEY, GDP=DOUBLE, DebtRatio=MONEY, DeficitRatio=MONEY,
    InflationRate=MONEY, ConsumerPriceIndex=MONEY, HousePriceIndex=MONEY,
)

DATASETS = {"Loan": LOAN, "Fraud": FRAUD, "Market": MARKET, "Macro": MACRO}

LINEAGE = ("LoadBatchID", "LoadDate", "LastUpdated", "DataSourceFile")
