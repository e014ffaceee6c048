"""Model replies: normalisation of heterogeneous JSON, the deterministic gate, verdict parsing, and the call boundary."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import truncate
from ..runtime import Cuts
from ..sources.training import strip

# Ranks of difficulty.
RANKS = {"easy": 0, "medium": 1, "hard": 2}


def json_payload(c: Column, lists_first: bool = False) -> Column:
    """The JSON value inside a reply: without code fences, whole, else from the first brace to the last, else brackets (or brackets first). Null where none parses."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))
    braces, brackets = F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.regexp_extract(bare, r"(?s)(\[.*\])", 1)
    inner = [F.try_parse_json(F.when(x != "", x)) for x in ((brackets, braces) if lists_first else (braces, brackets))]
    return F.coalesce(F.try_parse_json(bare), *inner)


def _text(v: Column, *names: str) -> Column:
    """The first named field that is not blank, as text."""
    found = [F.when(strip(F.try_variant_get(v, f"$.{n}", "string")) != "", strip(F.try_variant_get(v, f"$.{n}", "string"))) for n in names]
    return F.coalesce(*found, F.lit(""))


def _strings(v: Column, name: str) -> Column:
    return F.filter(F.transform(F.coalesce(F.try_variant_get(v, f"$.{name}", "array<string>"), F.array().cast("array<string>")), strip), lambda x: x != "")


def normalize_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """replies with verdict, answer_support, distinctness, citation_quality, eval_quality, difficulty, supporting_chunk_ids, too_similar_refs, reason.

    Older field names are understood; a reply that is no JSON object fails every check and has no difficulty.
    """
    v = F.col("_v")
    parsed = replies.withColumn("_p", json_payload(F.coalesce(reply, F.lit(""))))
    parsed = parsed.withColumn("_v", F.when(F.schema_of_variant("_p").startswith("OBJECT"), F.col("_p")))
    low = lambda *names: F.lower(_text(v, *names))
    verdict, support = low("verdict"), low("answer_support", "grounding")
    first_reason = F.coalesce(F.try_variant_get(v, "$.reasons[0]", "string"), F.try_variant_get(v, "$.reasons", "string"), F.lit(""))
    reason = F.when(_text(v, "reason") != "", _text(v, "reason")).otherwise(strip(first_reason))
    quality = F.when(low("citation_quality") != "", low("citation_quality")).when(low("chunk_sufficiency") == "sufficient", "sufficient").otherwise("insufficient")
    use = F.when(low("eval_quality") != "", low("eval_quality")).when(low("trap_fairness") == "unfair", "unfair").when(low("usefulness") == "useful", "useful").otherwise("weak")
    valid = verdict.isin("accept", "reject")
    refs = F.concat(_strings(v, "too_similar_refs"), _strings(v, "distinctness_check.too_similar_run_previous_assignment_ids"))
    is_object = v.isNotNull()
    pick = lambda good, bad: F.when(is_object, good).otherwise(F.lit(bad))
    out = parsed.withColumns(
        {
            "verdict": pick(F.when(valid, verdict).otherwise("reject"), "reject"),
            "answer_support": pick(F.when(support == "partial", "unsupported").otherwise(support), "unsupported"),
            "distinctness": pick(low("distinctness"), "too_similar"),
            "citation_quality": pick(F.when(F.size(_strings(v, "unnecessary_chunk_ids")) > 0, "over_cited").otherwise(quality), "insufficient"),
            "eval_quality": pick(use, "weak"),
            "difficulty": pick(F.when(low("difficulty").isin(*RANKS), low("difficulty")).otherwise("easy"), ""),
            "supporting_chunk_ids": F.when(is_object, _strings(v, "supporting_chunk_ids")).otherwise(F.array().cast("array<string>")),
            "too_similar_refs": F.when(is_object, F.array_sort(F.array_distinct(refs))).otherwise(F.array().cast("array<string>")),
            "reason": pick(truncate(F.when((reason == "") & ~valid, F.lit("invalid_verdict")).otherwise(reason), 500), "judge_response_not_object"),
        }
    )
    return out.drop("_p", "_v")


def gate(normalized: DataFrame, cited: str = "chunk_ids", least: str = "medium") -> DataFrame:
    """normalized with gate_reasons, status (accept where there are none, else reject) and reject_reason, the first."""
    rank = F.lit(-1)
    for name, value in RANKS.items():
        rank = F.when(F.col("difficulty") == name, value).otherwise(rank)
    named = lambda c: F.when(F.col(c) == "", "invalid").otherwise(F.col(c))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("verdict") != "accept", F.lit("judge_verdict_reject")),
            F.when(F.col("answer_support") != "supported", F.lit("answer_not_supported")),
            F.when(F.col("distinctness") != "distinct", F.lit("too_similar")),
            F.when(F.col("citation_quality") != "sufficient", F.concat(F.lit("citation_"), named("citation_quality"))),
            F.when(F.col("eval_quality") != "useful", F.concat(F.lit("eval_quality_"), named("eval_quality"))),
            F.when(rank < RANKS.get(least, 1), F.lit("difficulty_too_low")),
            F.when(F.size("supporting_chunk_ids") == 0, F.lit("missing_supporting_chunk_ids")).when(F.size(F.array_except("supporting_chunk_ids", cited)) > 0, F.lit("supporting_chunk_outside_cited")),
        )
    )
    marked = normalized.withColumn("gate_reasons", reasons)
    return marked.withColumns({"status": F.when(F.size("gate_reasons") == 0, "accept").otherwise("reject"), "reject_reason": F.get("gate_reasons", F.lit(0))})


def parse_verdicts(replies: DataFrame, rows: DataFrame, single: bool = False) -> DataFrame:
    """(batch, local_id, decision, reason) for each of rows (batch, local_id), from replies (batch, reply).

    A reply is a list of items, an object with `decisions`, or one item. An item names its row by row_id, else id; of several the
    last counts. Other decisions than KEEP and REJECT reject as unparseable_decision, a row without item as missing_from_batch_response.
    single: batches of one row, whose item need not name it.
    """
    parsed = replies.select("batch", json_payload(F.coalesce("reply", F.lit("")), lists_first=True).alias("p"))
    kind = F.schema_of_variant("p")
    listed = F.when(kind.startswith("ARRAY"), F.try_variant_get("p", "$", "array<variant>")).when(F.try_variant_get("p", "$.decisions", "variant").isNotNull(), F.try_variant_get("p", "$.decisions", "array<variant>")).when(kind.startswith("OBJECT"), F.array("p"))
    items = parsed.select("batch", F.posexplode(listed).alias("at", "v"))
    named = F.coalesce(F.try_variant_get("v", "$.row_id", "string"), F.try_variant_get("v", "$.id", "string")).try_cast("long")
    named = F.coalesce(named, F.lit(0).cast("long")) if single else named
    text = lambda *names: F.coalesce(*[F.when(strip(F.try_variant_get("v", f"$.{n}", "string")) != "", strip(F.try_variant_get("v", f"$.{n}", "string"))) for n in names], F.lit(""))
    said = F.upper(text("decision", "verdict"))
    known = said.isin("KEEP", "REJECT")
    blank = said == ""
    found = items.select("batch", named.alias("local_id"), "at", F.when(known, said).otherwise("REJECT").alias("decision"), F.when(known | blank | (text("reason") != ""), text("reason")).otherwise("unparseable_decision").alias("reason")).where("local_id is not null")
    last = found.groupBy("batch", "local_id").agg(F.max_by(F.struct("decision", "reason"), "at").alias("f"))
    both = rows.select("batch", "local_id").join(last, ["batch", "local_id"], "left")
    return both.select("batch", "local_id", F.coalesce("f.decision", F.lit("REJECT")).alias("decision"), F.coalesce("f.reason", F.lit("missing_from_batch_response")).alias("reason"))


MAX_TOKENS = 8000


def call_model(prompts: DataFrame, ask: Callable[..., str], attempts: int = 3, max_tokens: int | None = None, usable: Callable[[str], bool] | None = None) -> DataFrame:
    """(id, reply, attempts, error) for prompts (id, prompt), by an injected function that is called once or up to `attempts` times a row.

    With max_tokens the function gets a second argument, which doubles with each failed attempt, up to MAX_TOKENS. A reply that is
    not usable is a failed attempt too. Rows are spread over the partitions of prompts. Write the result before any later step
    reads it twice: a plan that is evaluated again calls again. A row whose attempts all fail has a null reply and the last error.
    """
    schema = T.StructType([prompts.schema["id"], T.StructField("reply", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, prompt in zip(frame["id"], frame["prompt"], strict=True):
                reply, error, n, budget = None, None, 0, max_tokens
                while reply is None and n < attempts:
                    n += 1
                    try:
                        said = ask(prompt) if budget is None else ask(prompt, budget)
                        if usable is not None and not usable(said):
                            raise ValueError("the reply is not usable")
                        reply = said
                    except Exception as e:  # whatever the injected function raises is a failed attempt
                        error = f"{type(e).__name__}: {e}"
                        budget = budget and min(2 * budget, MAX_TOKENS)
                out.append((key, reply, n, None if reply is not None else error))
            yield pd.DataFrame(out, columns=schema.names)

    return prompts.select("id", "prompt").mapInPandas(run, schema)


def judge(packets: DataFrame, cited: DataFrame, rejected: DataFrame, ask: Callable[..., str], *, max_tokens: int = 700, least: str = "medium", workers: int = 2, version: str = "v1") -> DataFrame:
    """(row_id, status, reject_reason, gate_reasons, judge_version, error) of every candidate, in order of row_id.

    packets: row_id, packet; cited: row_id, chunk_ids; rejected: row_id, reason, from preflight, which are not shown to the model.
    A row whose attempts all fail is rejected as judge_error. The calls are made once, as their results are written.
    """
    asked = packets.select(F.col("row_id").alias("id"), F.concat(F.lit("Judge this row:\n\n"), "packet").alias("prompt")).repartition(workers)
    called = Cuts(packets.sparkSession, "judge").cut(call_model(asked, ask, max_tokens=max_tokens, usable=lambda t: "{" in t or "[" in t))
    said = called.where("error is null").select(F.col("id").alias("row_id"), "reply").join(cited.select("row_id", "chunk_ids"), "row_id")
    gated = gate(normalize_replies(said), least=least).select("row_id", "status", "reject_reason", "gate_reasons", F.lit(None).cast("string").alias("error"))
    none = F.array().cast("array<string>")
    failed = called.where("error is not null").select(F.col("id").alias("row_id"), F.lit("reject").alias("status"), F.lit("judge_error").alias("reject_reason"), none.alias("gate_reasons"), "error")
    before = rejected.select("row_id", F.lit("reject").alias("status"), F.col("reason").alias("reject_reason"), none.alias("gate_reasons"), F.lit(None).cast("string").alias("error"))
    return gated.unionByName(failed).unionByName(before).withColumn("judge_version", F.lit(version)).orderBy("row_id")
