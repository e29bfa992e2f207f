"""Calls to a language model behind a cache; offline the answers are replayed or NULL.

A client has ``generate(prompts: list[str]) -> list[str | None]`` and is built once
per partition by a factory. Only prompts without a cached answer are sent, each
distinct prompt once; calls that fail are tried again with doubling pauses.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.session import cut


def generate(prompts: DataFrame, cache: DataFrame, factory: Callable[[], object], batch: int = 5, retries: int = 3, pause: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(answers for every prompt row, new cache entries). prompts: id, prompt; cache: key, response."""
    keyed = prompts.withColumn("key", F.sha2("prompt", 256))
    open_ = keyed.select("key", "prompt").dropDuplicates(["key"]).join(cache.select("key").distinct(), "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for b in batches:
            texts, out = list(b["prompt"]), []
            for i in range(0, len(texts), batch):
                part = texts[i : i + batch]
                for attempt in range(retries + 1):
                    try:
                        out += list(client.generate(part))
                        break
                    except Exception:
                        if attempt == retries:
                            out += [None] * len(part)
                        else:
                            time.sleep(pause * 2**attempt)
            yield pd.DataFrame({"key": b["key"], "response": out})

    made = cut(open_.mapInPandas(run, "key string, response string"))
    known = cache.select("key", "response").unionByName(made).groupBy("key").agg(F.first("response", ignorenulls=True).alias("response"))
    return keyed.join(known, "key", "left").drop("key"), made.where("response IS NOT NULL")


class Replay:
    """A client that answers from a given mapping, and NULL otherwise."""

    def __init__(self, answers: dict[str, str] | None = None) -> None:
        self.answers = answers or {}

    def generate(self, prompts: list[str]) -> list[str | None]:
        return [self.answers.get(p) for p in prompts]


def parse_score(response) -> tuple:
    """(score, rationale) of a reply: JSON ``score`` clamped, else the first decimal from 0 to 1, else NULL with the text."""
    js = F.coalesce(F.get_json_object(response, "$.score"), F.get_json_object(F.regexp_extract(response, r"(?s)\{.*\}", 0), "$.score"))
    num = F.coalesce(js.try_cast("double"), F.nullif(F.regexp_extract(response, r"([01]?\.[0-9]+)", 1), F.lit("")).try_cast("double"))
    score = F.when(num.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), num)))
    return score, F.coalesce(F.get_json_object(response, "$.rationale"), response)


def parse_answer(response) -> tuple:
    """(answer, confidence) of a reply whose ``answer`` is text, an object or a list of either."""
    get = lambda p: F.get_json_object(response, p)
    pick = lambda root: F.coalesce(*[get(f"{root}.{k}") for k in ("label", "value", "answer", "text")])
    plain = F.when(~F.coalesce(get("$.answer"), F.lit("")).rlike(r"^\s*[\[{]"), get("$.answer"))
    first = F.coalesce(pick("$.answer[0]"), F.when(~F.coalesce(get("$.answer[0]"), F.lit("")).rlike(r"^\s*[\[{]"), get("$.answer[0]")))
    answer = F.coalesce(pick("$.answer"), plain, first)
    conf = F.coalesce(get("$.confidence"), get("$.answer.confidence"), get("$.answer[0].confidence")).try_cast("double")
    return F.trim(answer), F.when(conf.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf)))
