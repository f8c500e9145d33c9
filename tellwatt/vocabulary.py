"""Names and formats that stored tables already use.

Fixed values: a reader of existing files needs exactly these.
"""

from pyspark.sql import types as T

# Column names of the stored tables.
KEY = "NIO"
CITY = "MUNICIPIO"
BRAND = "INTELIGENTE"
FLAG = "DISP"
DAY = "DATA"
ORIGIN = "ORIGEM"
COMM = "CONTAGEM_COMM"
TOTAL = "CONTAGEM_TOT"
RATIO = "DISP"

# Key column name of the second origin's raw CSV.
RAW_KEY = "Device No."

# Origins in order of precedence, and the tag of their merged flags.
ORIGINS = ("ORCA", "SANPLAT")
MERGED_ORIGIN = "MIXED"

# Brands that count as smart meters.
SMART_BRANDS = ("Hexing", "Nansen", "Nansen Ipiranga")

# Accepted date spellings, as Spark patterns and as strptime patterns.
SPARK_DATE_PATTERNS = ("d/M/yyyy", "d-M-yyyy", "yyyy-M-d")
PYTHON_DATE_PATTERNS = ("%d/%m/%Y", "%d-%m-%Y", "%Y-%m-%d")

# Spelling of a day in a wide table's header.
HEADER_DATE_PATTERN = "%d/%m/%Y"

# File names: one universe file per day, one result file per month. A universe that
# Spark has partitioned by a column "file" has the same names behind "file=".
UNIVERSE_GLOB = "{{Diario,file=Diario}}_{day}.parquet"
UNIVERSE_NAME = r"/(?:file=)?Diario_(\d{4}-\d{2}-\d{2})\.parquet"
MONTH_RESULT_NAME = r"(?i)/municipio_(\d{4}-\d{2})\.(csv|parquet)"

# Name of the day folders of a table that grows by day.
DAY_FOLDER = "day"

# Delimiters in order of preference, and the one used when none is seen.
DELIMITERS = (";", ",", "\t", "|")
DEFAULT_DELIMITER = ","

DEFAULT_WINDOW_DAYS = 5

# CSV text as common tools have it: a quote in a field is doubled, spaces belong to it.
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Stands for a field with nothing in it while reading, so that a quoted empty text isn't null.
CSV_NOTHING = "\u0000"

RESULT_SCHEMA = T.StructType([
    T.StructField(CITY, T.StringType()),
    T.StructField(BRAND, T.StringType()),
    T.StructField(COMM, T.LongType()),
    T.StructField(TOTAL, T.LongType()),
    T.StructField(RATIO, T.DoubleType()),
    T.StructField(DAY, T.StringType()),
])

UNIVERSE_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField(CITY, T.StringType()),
    T.StructField(DAY, T.DateType()),
])

BRAND_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField(BRAND, T.StringType()),
])
