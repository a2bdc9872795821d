"""The raw transaction record and the column lists shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The input record, in file order.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("card_number", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

# The trailing Z is a quoted literal, so the reader takes the text as wall-clock
# time; sources pin the zone to UTC to make the instant right as well.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"
WRITTEN_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

CORRUPT_RECORD = "_corrupt_record"
IS_CORRUPT = "is_corrupt"

TRANSACTION_FIELDS = TRANSACTION_SCHEMA.fieldNames()
TEXT_FIELDS = [f.name for f in TRANSACTION_SCHEMA if f.dataType == T.StringType()]

MERCHANT_DAY = ["merchant_id", "transaction_date"]
