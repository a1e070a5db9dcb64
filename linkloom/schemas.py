"""Row types of the tables the jobs read and write."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_text = T.StringType()

API_ITEM = _struct(title=_text, originallink=_text, pubDate=_text)
API_BODY = _struct(items=T.ArrayType(API_ITEM))
API_RESPONSE = _struct(keyword=_text, start=T.IntegerType(), body=API_BODY)

LINK = _struct(title=_text, link=_text, date=_text)
PAGE = _struct(url=_text, html=_text)
FETCH_LOG = _struct(
    url=_text, status=T.IntegerType(), error=_text, fetched_at=T.TimestampNTZType()
)

TOTAL_URL = _struct(url=_text, created_at=_text)
REQUEST_URL = _struct(
    status_code=T.IntegerType(),
    url=_text,
    title=_text,
    content=_text,
    keyword=_text,
    score=T.DoubleType(),
    created_at=_text,
    updated_at=_text,
)
NOT_REQUEST_URL = _struct(
    status_code=T.IntegerType(), url=_text, title=_text, created_at=_text, updated_at=_text
)

RECHECK_RECORD = _struct(id=T.LongType(), link=_text, title=_text, date=_text)
EDGE = _struct(url=_text, link=_text, pos=T.LongType())
