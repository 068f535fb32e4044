"""Explicit schema of every stored dataset, and a projection onto it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

LONG, STRING, DOUBLE = LongType(), StringType(), DoubleType()


def schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


PAGES = schema(fid=LONG, furl=STRING, ftitle=STRING, fkeywords=STRING, fcontent=STRING)
ARTICLES = schema(fid=LONG, ftitle=STRING, fcontent=STRING, fcategory=STRING, fresource_type=LONG)
READER_LOG = schema(imei=STRING, article_id=STRING, read_cnt=LONG, event_name=STRING)
CLICK_LOG = schema(imei=STRING, category=STRING, pv=LONG)

SEG = schema(fid=LONG, words=STRING)
HASH = schema(fid=LONG, hash=LONG)
KEY = schema(fid=LONG, words=STRING, hash=LONG, furl=STRING, ftitle=STRING)
DISCARD = schema(fid=LONG, words=STRING, hash=LONG)
# Counts of documents are bigint: an int would overflow on a large crawl.
SAME = schema(hash=LONG, fid=LONG, samelen=LONG)
DISTANCE = schema(fid=LONG, hash=LONG, samelen=LONG, members=ArrayType(LONG))
DUP = schema(
    fid=LONG, hash=LONG, samelen=LONG, furl=STRING, ftitle=STRING, fkeywords=STRING, fcontent=STRING
)
DUP_TOPICS = StructType([*DUP.fields, StructField("cat", STRING), StructField("prob", DOUBLE)])
MEMBERS = schema(rep_fid=LONG, fid=LONG)
PREDICTION = schema(fid=LONG, words=STRING, cat=STRING, prob=DOUBLE)
USER_PV = schema(imei=STRING, fid=LONG, sumcnt=LONG)
EDITOR_TOPICS = schema(fid=LONG, fcategory=STRING)
FID_CAT = schema(fid=LONG, cat=STRING)
USER_TOPICS = schema(imei=STRING, pcat=STRING, ccat=STRING, cnt=LONG)
LABEL_COUNTS = schema(label=STRING, n=LONG)
TRAIN = schema(cat=STRING, title=STRING, content=STRING, resource_type=LONG)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to exactly the columns of ``schema``."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
