"""The chunk store as a source: documents are fetched by an injected function, with retries, a check of what came back, and error kinds."""

from __future__ import annotations

import json
import socket
import time
import urllib.error
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse
from ..operators.hydrate import clean_text

# HTTP statuses that are worth another attempt.
RETRYABLE = frozenset({429, 500, 502, 503, 504})
FETCHED = "doc_id string, fetch_status string, fetch_error_kind string, error string, attempts int, fields string"


def error_kind(error: BaseException) -> str:
    """The kind of a failed fetch: http_<status>, network_permission_denied, connection_refused, timeout, url_error, invalid_json_response, else the class."""
    if isinstance(error, urllib.error.HTTPError):
        return f"http_{error.code}"
    cause = error.reason if isinstance(error, urllib.error.URLError) else error
    if isinstance(cause, PermissionError) and cause is not error:
        return "network_permission_denied"
    if isinstance(cause, ConnectionRefusedError) and cause is not error:
        return "connection_refused"
    if isinstance(cause, TimeoutError | socket.timeout):
        return "timeout"
    if isinstance(error, urllib.error.URLError):
        return "url_error"
    return "invalid_json_response" if isinstance(error, json.JSONDecodeError) else type(error).__name__


def fetch_one(doc_id: str, look_up: Callable[[str], dict | None], retries: int, backoff: float, wait: Callable[[float], None] = time.sleep) -> dict:
    """One document's record. look_up gives the fields of the first hit, None for none, or raises."""
    attempts = max(1, retries + 1)
    for attempt in range(1, attempts + 1):
        try:
            fields = look_up(doc_id)
        except Exception as e:  # whatever the injected function raises is a failed attempt
            final = isinstance(e, urllib.error.HTTPError) and e.code not in RETRYABLE
            if final or attempt == attempts:
                return {"doc_id": doc_id, "fetch_status": "error", "fetch_error_kind": error_kind(e), "error": f"{type(e).__name__}: {e}", "attempts": attempt, "fields": None}
            wait(backoff * attempt)
            continue
        if fields is None:
            return {"doc_id": doc_id, "fetch_status": "no_hit", "fetch_error_kind": None, "error": None, "attempts": attempt, "fields": None}
        returned = " ".join(str(fields.get("docId") or "").split())
        if returned != doc_id:
            return {"doc_id": doc_id, "fetch_status": "wrong_doc", "fetch_error_kind": "wrong_doc", "error": f"expected {doc_id}, got {returned or '<blank>'}", "attempts": attempt, "fields": None}
        return {"doc_id": doc_id, "fetch_status": "ok", "fetch_error_kind": None, "error": None, "attempts": attempt, "fields": json.dumps(fields, ensure_ascii=False)}
    raise AssertionError("unreachable")


def fetch_documents(requested: DataFrame, look_up: Callable[[str], dict | None], *, retries: int = 2, backoff: float = 0.5) -> DataFrame:
    """The record of each requested document (doc_id), fetched once. Write the result before it is read twice: a plan evaluated again fetches again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([fetch_one(d, look_up, retries, backoff) for d in frame["doc_id"]], columns=[c.split()[0] for c in FETCHED.split(", ")])

    return requested.select("doc_id").distinct().mapInPandas(run, FETCHED)


def _chunk_text(v: Column) -> Column:
    """A chunk is a text, or an object with its text under `chunk`, else `text`; anything else is empty."""
    kind = F.schema_of_variant(v)
    field = lambda n: F.nullif(F.try_variant_get(v, f"$.{n}", "string"), F.lit(""))
    return F.when(kind == "STRING", v.cast("string")).when(kind.startswith("OBJECT"), F.coalesce(field("chunk"), field("text"), F.lit(""))).otherwise("")


def doc_metadata(fetched: DataFrame) -> DataFrame:
    """(doc_id, title, file_name, document_date, referenced_ids) of fetched documents, blanks collapsed; missing fields read as empty."""
    v = F.try_parse_json("fields")
    text = lambda n: collapse(F.coalesce(F.try_variant_get(v, f"$.{n}", "string"), F.lit("")))
    return fetched.select("doc_id", text("title").alias("title"), text("fileName").alias("file_name"), text("document_date").alias("document_date"), F.coalesce(F.try_variant_get(v, "$.referenced_ids", "array<string>"), F.array().cast("array<string>")).alias("referenced_ids"))


def hydrated_chunks(requested: DataFrame, fetched: DataFrame, *, label: str = "store") -> DataFrame:
    """(chunk_id, doc_id, chunk_index, hydration_status, fetch_status, fetch_error_kind, text, text_sha256, pages, labels) for requested
    (doc_id, chunk_indexes) and fetched documents.

    An index outside the document's list of chunks is missing_chunk; of a document that was not fetched, or came back as another, all are
    <label>_fetch_error, _doc_missing or _wrong_doc. Pages and labels come from the metadata of the chunk's index, else position.
    """
    one = requested.select("doc_id", F.explode("chunk_indexes").alias("chunk_index")).join(fetched, "doc_id", "left")
    v = F.try_parse_json("fields")
    chunks = F.try_variant_get(v, "$.chunks_summary", "array<variant>")
    chunk = F.when(F.col("chunk_index").between(0, F.coalesce(F.size(chunks), F.lit(0)) - 1), F.get(chunks, F.col("chunk_index").cast("int")))
    about = F.transform(F.coalesce(F.try_variant_get(v, "$.chunks_map", "array<variant>"), F.array().cast("array<variant>")), lambda x, i: F.struct(F.coalesce(F.try_variant_get(x, "$.chunk_index", "long"), i.cast("long")).alias("key"), x.alias("x")))
    mine = F.element_at(F.filter(about, lambda m: (m["key"] == F.col("chunk_index")) & F.schema_of_variant(m["x"]).startswith("OBJECT")), -1)["x"]
    failed = F.when(F.col("fetch_status") == "no_hit", f"{label}_doc_missing").when(F.col("fetch_status") == "wrong_doc", f"{label}_wrong_doc").otherwise(f"{label}_fetch_error")
    fine = F.coalesce(F.col("fetch_status") == "ok", F.lit(False))
    status = F.when(~fine, failed).when(chunk.isNull(), "missing_chunk").otherwise("ok")
    sized = F.size(F.filter(about, lambda m: m["key"] == F.col("chunk_index"))) > 0
    part = lambda name, kind: F.coalesce(F.when(sized, F.try_variant_get(mine, f"$.{name}", kind)), F.array().cast(kind))
    out = one.select(F.concat_ws("#", "doc_id", F.col("chunk_index").cast("string")).alias("chunk_id"), "doc_id", "chunk_index", status.alias("hydration_status"), "fetch_status", "fetch_error_kind", F.when(status == "ok", clean_text(_chunk_text(chunk))).alias("text"), part("page_numbers", "array<int>").alias("pages"), part("block_labels", "array<string>").alias("labels"))
    return out.withColumn("text_sha256", F.sha2("text", 256))


def card_counts(hydrated: DataFrame, fetched: DataFrame, units: DataFrame) -> DataFrame:
    """(assignment_id, doc_status_counts, chunk_status_counts, error_kind_counts, attempts): maps of what was fetched for each unit (assignment_id, chunk_ids)."""
    one = units.select("assignment_id", F.explode("chunk_ids").alias("chunk_id")).join(hydrated.select("chunk_id", "doc_id", "hydration_status"), "chunk_id")
    docs = one.select("assignment_id", "doc_id").distinct().join(fetched, "doc_id")
    counted = lambda df, c: df.groupBy("assignment_id", F.col(c).alias("k")).count().groupBy("assignment_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "count")))).alias("m"))
    failed = docs.where("fetch_status <> 'ok'").withColumn("kind", F.coalesce("fetch_error_kind", F.lit("none")))
    out = docs.groupBy("assignment_id").agg(F.sum("attempts").alias("attempts"))
    for name, df, c in (("doc_status_counts", docs, "fetch_status"), ("chunk_status_counts", one, "hydration_status"), ("error_kind_counts", failed, "kind")):
        out = out.join(counted(df, c).withColumnRenamed("m", name), "assignment_id", "left")
    return out
