"""Column names, schemas and the fixed values every module shares."""

from pyspark.sql import types as T

# Column names of the data model.
DATE = "Date"
PRICE = "Unit Price"
QUANTITY = "Quantity"
TX_ID = "Transaction ID"
STORE = "Store Location"
PRODUCT = "Product Name"
PRODUCER = "Producer ID"
TOTAL = "Total Quantity"

# Products accepted by the cleaning job.
REFERENCE_PRODUCTS = [
    "milk",
    "coffee",
    "wheat",
    "chocolate",
    "beef",
    "sugar",
    "corn",
    "soybeans",
]

RAW_COLUMNS = [DATE, PRICE, QUANTITY, TX_ID, STORE, PRODUCT, PRODUCER]
DAILY_COLUMNS = [PRODUCT, TOTAL, DATE]

# Columns the readers add: which file a row came from and where in it.
SOURCE_FILE = "source_file"
BLOCK = "row_block"
SEQ = "row_seq"

BRONZE = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

TYPED = T.StructType(
    [
        T.StructField(DATE, T.TimestampNTZType()),
        T.StructField(PRICE, T.DoubleType()),
        T.StructField(QUANTITY, T.LongType()),
        T.StructField(TX_ID, T.StringType()),
        T.StructField(STORE, T.StringType()),
        T.StructField(PRODUCT, T.StringType()),
        T.StructField(PRODUCER, T.StringType()),
    ]
)

DAILY = T.StructType(
    [
        T.StructField(DATE, T.DateType()),
        T.StructField(PRODUCT, T.StringType()),
        T.StructField(TOTAL, T.LongType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("version_ts", T.TimestampType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("updated", T.TimestampType()),
    ]
)
