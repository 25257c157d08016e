"""Rows from language models: answers are parsed in Spark, the model itself is an injected callable."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekha.functions import text
from lekha.operators.curate import seen_filter

_ITEM = "struct<roman_text:string,roman:string,telugu_text:string,telugu:string>"


def json_pairs(raw: Column) -> Column:
    """array<struct<...>> of the pairs in an answer: its fence is removed, then the part from the first ``[`` to the last ``]`` is read; if that fails, each flat object in it that can be read."""
    fenced = F.regexp_extract(raw, r"(?s)```(?:json)?\s*(\[.*?\])\s*```", 1)
    body = F.regexp_extract(F.when(fenced != "", fenced).otherwise(raw), r"(?s)\[.*\]", 0)
    whole = F.from_json(body, f"array<{_ITEM}>")
    objects = F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"(\{[^{}]+\})"), 1), lambda o: F.from_json(o, _ITEM)), lambda x: x.isNotNull() & (F.coalesce(x["roman_text"], x["roman"], x["telugu_text"], x["telugu"]).isNotNull()))
    return F.when(body == "", F.array().cast(f"array<{_ITEM}>")).otherwise(F.coalesce(F.filter(whole, lambda x: x.isNotNull()), objects))


def parsed_pairs(answers: DataFrame, column: str = "answer") -> DataFrame:
    """A row per pair of an answer, with roman_text, telugu_text and the reason of refusal (null if accepted)."""
    rows = answers.select("*", F.posexplode(json_pairs(F.col(column))).alias("item", "p"))
    side = lambda a, b: text.strip(F.coalesce(F.col(f"p.{a}"), F.col(f"p.{b}"), F.lit("")))
    return rows.withColumn("roman_text", side("roman_text", "roman")).withColumn("telugu_text", text.nfc(side("telugu_text", "telugu"))).drop("p").withColumn("refused", text.synthetic_reason(F.col("roman_text"), F.col("telugu_text")))


def accepted_pairs(answers: DataFrame, seen: DataFrame, column: str = "answer", order: str = "seq") -> DataFrame:
    """Accepted pairs whose Roman text was not seen before (``seen`` has row_hash), the first of each."""
    rows = parsed_pairs(answers, column).where("refused is null").withColumn("_n", F.struct(order, "item"))
    return seen_filter(rows, seen, order="_n").drop("_n")


def trace(answers: DataFrame, column: str = "answer", order: str = "seq") -> DataFrame:
    """(seq, raw_chars, parsed, accepted, notes): what came of each answer, before known texts are left out."""
    by = parsed_pairs(answers, column).groupBy(order).agg(F.count(F.lit(1)).alias("parsed"), F.count_if(F.col("refused").isNull()).alias("accepted"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = answers.select(order, F.coalesce(F.char_length(column), F.lit(0)).alias("raw_chars"), F.col(column).isNull().alias("_none")).join(by, order, "left")
    notes = F.when(F.col("_none"), F.array(F.lit("unavailable"))).otherwise(F.array(F.concat(F.lit("rejected="), (F.coalesce("parsed", F.lit(0)) - F.coalesce("accepted", F.lit(0))).cast("string"))))
    return out.select(order, "raw_chars", zero("parsed"), zero("accepted"), notes.alias("notes"))


def category_counts(df: DataFrame) -> DataFrame:
    """(category, n): Roman records by category; null is unknown."""
    return df.where("script_hint = 'roman'").groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def with_retries(ask: Callable[..., str | None], tries: int = 3, wait: Callable[[float], None] = time.sleep) -> Callable[..., str | None]:
    """``ask`` that is tried again after an OSError (lost connections, time-outs, refused answers), 2, 4, ... seconds later; None when every try fails."""

    def asked(*args: object) -> str | None:
        for k in range(1, tries + 1):
            try:
                return ask(*args)
            except OSError:
                if k < tries:
                    wait(2.0**k)
        return None

    return asked


def generate(ask: Callable[[int], str | None], keep: Callable[[str], int], target: int, batch: int = 15, patience: int = 3) -> int:
    """Ask until ``target`` pairs are kept; stops when no answer comes or after ``patience`` answers without a kept pair. Returns the kept pairs."""
    done = empty = 0
    while done < target and empty < patience:
        answer = ask(min(batch, target - done + batch // 2))
        if answer is None:
            break
        got = keep(answer)
        done, empty = done + got, 0 if got else empty + 1
    return done


def generated_records(pairs: DataFrame, ts: str, model: str, prompt_version: str, url: str = "", licence: str = "Apache-2.0") -> DataFrame:
    """Two raw records for each accepted pair (roman_text, telugu_text, category), named syn_{category}_{uuid}_ro and _te; the UUID is made of the texts, so a repeated run names them alike."""
    key = F.md5(F.concat_ws("\x1e", "category", "roman_text", "telugu_text"))
    uid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    one = lambda t, side, hint: F.struct(F.concat(F.lit("syn_"), F.coalesce("category", F.lit("unknown")), F.lit("_"), uid, F.lit(f"_{side}")).alias("source_doc_id"), F.col(t).alias("text_raw"), F.lit(hint).alias("script_hint"))
    rows = pairs.select(F.explode(F.array(one("roman_text", "ro", "roman"), one("telugu_text", "te", "telugu"))).alias("r"), "category").select("r.*", "category")
    fixed = {"source_name": "ollama_synthetic", "source_url": url, "license_tag": licence, "pull_timestamp_utc": ts, "lang_hint": "te", "model": model, "prompt_version": prompt_version}
    return rows.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumn("row_hash", text.row_hash(F.col("text_raw")))


def scored_by(complete: Callable[[str], str], template: str) -> Callable[[str, str], str]:
    """An ``ask`` for :func:`review_scores` that fills {telugu_text} and {roman_text} of a prompt template and hands it to a completion client."""
    return lambda te, ro: complete(template.replace("{telugu_text}", te or "").replace("{roman_text}", ro or ""))


def review_scores(df: DataFrame, ask: Callable[[str, str], str] | None = None, most: int | None = 500, order: str = "seq") -> DataFrame:
    """The first ``most`` pairs (None: all) with ollama_score, ollama_reason, ollama_flag, ollama_model.

    ``ask`` gets both texts and returns the answer; a missing client, an error and an
    unreadable answer give a null score and the reason.
    """
    rows = df if most is None else df.orderBy(order).limit(most)

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, failed = [], []
            for te, ro in zip(b["telugu_text"], b["roman_text"]):
                try:
                    out.append(None if ask is None else ask(te, ro))
                    failed.append("ollama_unavailable" if ask is None else None)
                except TimeoutError:
                    out.append(None)
                    failed.append("timeout")
                except OSError:
                    out.append(None)
                    failed.append("ollama_unavailable")
            yield b.assign(_answer=out, _failed=failed)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _answer string, _failed string"
    asked = rows.mapInPandas(answers, schema)
    o = F.from_json(text.json_object(F.col("_answer")), "confidence_score double, reason_code string, flag_for_review boolean, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    good = F.col("_failed").isNull() & F.col("o").isNotNull() & F.col("o._bad").isNull()
    return asked.withColumn("o", o).withColumns({
        "ollama_score": F.when(good, F.coalesce("o.confidence_score", F.lit(0.5))),
        "ollama_reason": F.when(good, F.coalesce("o.reason_code", F.lit("unknown"))).otherwise(F.coalesce("_failed", F.lit("empty_response"))),
        "ollama_flag": F.when(good, F.coalesce("o.flag_for_review", F.lit(False))).otherwise(False),
        "ollama_model": F.when(good, "client"),
    }).drop("o", "_answer", "_failed")


def predictions(df: DataFrame, predict: Callable[[list[str]], list[str | None]], batch: int = 64, column: str = "roman_text") -> DataFrame:
    """Adds ``prediction`` from a batch model; one batch never spans Arrow batches. The predictions of a batch whose client fails with an OSError are null."""

    def asked(texts: list[str]) -> list[str | None]:
        try:
            return list(predict(texts))
        except OSError:
            return [None] * len(texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t or "" for t in b[column]]
            yield b.assign(prediction=[p for i in range(0, len(texts), batch) for p in asked(texts[i : i + batch])])

    return df.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", prediction string")


def first_line(reply: str | None) -> str | None:
    """What a chat model's reply says: its first non-blank line, trimmed; None without one."""
    return next((x.strip() for x in (reply or "").splitlines() if x.strip()), None)


def chat_predictions(df: DataFrame, chat: Callable[[str], str | None], column: str = "roman_text") -> DataFrame:
    """Adds ``prediction``, the first line of a chat model's reply to each text; any error of the client gives null."""

    def one(t: str) -> str | None:
        try:
            return first_line(chat(t))
        except Exception:  # a client may fail in any way, and a failed reply is no prediction
            return None

    return predictions(df, lambda texts: [one(t) for t in texts], column=column)
