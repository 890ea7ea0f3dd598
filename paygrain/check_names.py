"""Names of the data-quality checks.

Fixed values: these must equal the published names, by which reports are read.
"""

REQUIRED_COLUMNS = "required columns"
FORBIDDEN_COLUMNS = "forbidden columns"
TABLE_EXISTS = "table exists"
PARQUET_PARTS_EXIST = "parquet parts exist"
REQUIRED_FIELDS_NON_NULL = "required fields non-null"
TRANSACTION_STATUS_DOMAIN = "transaction_status domain"
DECLINE_REASON_LOGIC = "decline reason logic"
POSITIVE_TRANSACTION_AMOUNTS = "positive transaction amounts"
FRAUD_LOSS_LOGIC = "fraud loss logic"
PROCESSING_TIME_RANGE = "processing time range"
PRIMARY_KEY_NON_NULL = "primary key non-null"
PRIMARY_KEY_UNIQUE = "primary key unique"
EXPECTED_ROW_COUNT = "expected row count"
DATES_IN_CALENDAR = "dates in calendar"
FOREIGN_KEY = "foreign key"
EXPECTED_TOTAL_ROW_COUNT = "expected total row count"
GLOBAL_TRANSACTION_ID_RANGE = "global transaction_id range"
CROSS_BORDER_RULE = "cross-border rule"
