"""Small files and settings on the driver: summaries, KEY=VALUE files, prompts, run names, retry delays, chat replies."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_summary(path: str) -> dict:
    """A JSON object file; a missing one is empty."""
    return json.loads(Path(path).read_text(encoding="utf-8")) if os.path.exists(path) else {}


def write_summary(value: dict, path: str, sort_keys: bool = False) -> None:
    """An indented JSON file; keys in order where asked for."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False, sort_keys=sort_keys, default=str) + "\n", encoding="utf-8")


def read_env(path: str, required: bool = False) -> dict[str, str]:
    """KEY=VALUE lines: comments, blank lines and lines without `=` are skipped, `export` and a pair of quotes drop out. A missing file is empty, or an error where required."""
    if not os.path.exists(path):
        if required:
            raise FileNotFoundError(path)
        return {}
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        name, equals, value = line.strip().removeprefix("export ").partition("=")
        if equals and name.strip() and not name.startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out


def setting(name: str, default: str = "", env: dict[str, str] | None = None) -> str:
    """A setting from the process, else from a file that was read, else the default."""
    return os.environ.get(name) or (env or {}).get(name) or default


def int_setting(name: str, default: int, env: dict[str, str] | None = None) -> int:
    """The same as a number; what is no number reads as the default."""
    value = setting(name, "", env).strip()
    return int(value) if value.lstrip("-").isdigit() else default


def read_prompt(path: str) -> str:
    if not os.path.exists(path):
        raise FileNotFoundError(f"prompt file not found: {path}")
    return Path(path).read_text(encoding="utf-8")


def nonblank_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank, to see whether an output holds any work."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def append_event(spark: SparkSession, path: str, **event) -> None:
    """One event appended to a log of JSON lines, with its time."""
    row = {"at": int(time.time()), **event}
    spark.createDataFrame([(json.dumps(row, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("append").text(path)


def event_counts(events: DataFrame) -> DataFrame:
    """(event, count) of an event table: started, finished, failed, timed out and so on."""
    return events.groupBy("event").agg(F.count("*").alias("count"))


def run_id(at: float | None = None) -> str:
    """A run's name by the clock, in UTC."""
    return time.strftime("%Y%m%d_%H%M%S", time.gmtime(at))


def snapshot_id(at: float | None = None) -> str:
    return "train_" + run_id(at)


def iso_time(at: float | None = None) -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(at))


def retry_delay(attempt: int, retry_after: str | None = None) -> float:
    """Seconds before the next attempt (counted from 0): doubling up to 30, or what the server asks for, at least that and at most 60."""
    base = min(2**attempt, 30)
    try:
        return min(max(float(retry_after), base), 60) if retry_after else base
    except ValueError:
        return base


def reply_text(body: dict) -> str:
    """The text of a chat reply: the message's text, the joined texts of its parts, or the choice's own; without any it is an error."""
    choices = body.get("choices")
    choice = choices[0] if isinstance(choices, list) and choices and isinstance(choices[0], dict) else {}
    message = choice.get("message")
    content = message.get("content") if isinstance(message, dict) else None
    if isinstance(content, list):
        texts = [p if isinstance(p, str) else next((p[k] for k in ("text", "content") if isinstance(p.get(k), str)), "") if isinstance(p, dict) else "" for p in content]
        content = "".join(texts).strip()
    for text in (content, choice.get("text")):
        if isinstance(text, str) and text.strip():
            return text
    raise ValueError("the reply holds no text")
