"""Search requests and the JSON responses they land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.constants import API_ROWS_PER_REQUEST, PORTAL_SEARCH_URLS
from linkloom.functions.binding import exploded
from linkloom.functions.dates import pubdate_norm
from linkloom.schemas import API_BODY, API_RESPONSE


def request_plan(
    keywords: DataFrame,
    base_url: str,
    *,
    keyword: str = "keyword",
    first: int = 1,
    last: str | int = 1,
    step: int = API_ROWS_PER_REQUEST,
    encode: bool = False,
) -> DataFrame:
    """One request per keyword and start offset: keyword, start, url.

    ``last`` is an offset, or the name of a column holding each keyword's own.
    """
    stop = F.col(last) if isinstance(last, str) else F.lit(last)
    starts = F.sequence(
        F.lit(first).cast("bigint"),
        F.greatest(stop.cast("bigint"), F.lit(first).cast("bigint")),
        F.lit(step).cast("bigint"),
    )
    planned = keywords.select(F.col(keyword).alias("keyword"), F.explode(starts).alias("start"))
    term = F.url_encode(F.col("keyword")) if encode else F.col("keyword")
    return planned.select(
        "keyword",
        "start",
        F.concat(
            F.lit(f"{base_url}/news.json?query="),
            term,
            F.lit("&start="),
            F.col("start").cast("string"),
            F.lit(f"&display={step}"),
        ).alias("url"),
    )


def portal_requests(keywords: DataFrame, form: str, *, keyword: str = "keyword") -> DataFrame:
    """Put each keyword into a portal's search address: keyword, url.

    ``form`` is ``list``, ``result`` or ``card``, or an address with one ``%s``.
    """
    before, after = PORTAL_SEARCH_URLS.get(form, form).split("%s")
    return keywords.select(
        F.col(keyword).alias("keyword"),
        F.concat(F.lit(before), F.col(keyword), F.lit(after)).alias("url"),
    )


def read_api_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON responses, one object per line, read with their declared types."""
    return spark.read.schema(API_RESPONSE).json(path)


def parse_api_body(responses: DataFrame, *, body: str = "body") -> DataFrame:
    """Parse a response body kept as JSON text.

    ``reject_reason`` says why a response gives no items: no body, or one that is not an
    object with a list of items.  It is null for all others.
    """
    parsed = F.from_json(F.col(body), API_BODY)
    reason = F.when(F.col(body).isNull(), F.lit("no body")).when(
        parsed["items"].isNull(), F.lit("unreadable body")
    )
    return responses.withColumns({"reject_reason": reason, body: parsed})


def api_rejects(responses: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Parsed responses without items to read: keys, reject_reason."""
    return responses.filter("reject_reason is not null").select(*keys, "reject_reason")


def api_items(
    responses: DataFrame, *, keys: Sequence[str] = (), body: str = "body"
) -> DataFrame:
    """Items of each response in order: keys, pos, title, link, date (normalized)."""
    keys = list(keys)
    return exploded(responses, keys, F.col(f"{body}.items")).select(
        *keys,
        "pos",
        "item.title",
        F.col("item.originallink").alias("link"),
        pubdate_norm(F.col("item.pubDate")).alias("date"),
    )
