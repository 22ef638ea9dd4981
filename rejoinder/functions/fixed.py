"""Names, formats and texts that callers rely on."""

# Column names.
ORDER_KEY = "Order ID"
STAMP = "UpdatedOn"

# Formats and file names.
LANDING_FORMAT = "yyyyMMdd_HHmmss"
DATE_FORMAT = "dd-MM-yyyy"
PARQUET_SUFFIX = ".parquet"
EXPORT_NAME = "joined_orders_returns.csv"

# Run states.
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
TIMED_OUT = "TIMED_OUT"
ABORTED = "ABORTED"
TERMINAL_STATES = (SUCCEEDED, FAILED, TIMED_OUT, ABORTED)

# Texts of the run history.
ENTERED = "➡️ Entered: "
EXITED = "✅ Exited: "
FAILED_STEP = "❌ Failed: "

# Messages and subjects of the run notices.
SUCCESS_MESSAGE = "✅ Glue job succeeded! Orders File: {}, Returns File: {}"
SUCCESS_SUBJECT = "Glue Job Success Notification"
FAILURE_MESSAGE = "❌ ETL pipeline failed during Glue job execution."
FAILURE_SUBJECT = "Glue Job Failure Notification"

# Messages of the answers to a batch request.
BAD_REQUEST_MESSAGE = "❌ Missing orders_s3_key or returns_s3_key in input."
MISSING_FILE_MESSAGE = "❌ One or both input files are missing in S3."
STARTED_MESSAGE = "✅ Step Function triggered successfully"
START_ERROR_MESSAGE = "❌ Error triggering Step Function"

# Arguments of the job.
JOB_ARGUMENTS = ("JOB_NAME", "orders_s3_key", "returns_s3_key")

# Columns with the details of run events.
ENTERED_DETAILS = "stateEnteredEventDetails"
EXITED_DETAILS = "stateExitedEventDetails"
FAILED_DETAILS = "executionFailedEventDetails"

# Fields of the answers to a batch request.
ANSWER_CODE = "statusCode"
ANSWER_BODY = "body"
ANSWER_INPUT = "input"
ANSWER_MISSING = "missing_files"
ANSWER_EXECUTION = "executionArn"
ANSWER_ORDERS = "orders_file"
ANSWER_RETURNS = "returns_file"
ANSWER_TIME = "execution_at"
REQUEST_ORDERS = "orders_s3_key"
REQUEST_RETURNS = "returns_s3_key"
