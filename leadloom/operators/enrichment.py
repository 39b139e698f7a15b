"""A guarded call for each row: a result or an error, never a failed job.

The call (a text service, a lookup, any function of a row) runs inside the tasks, several rows of a batch
side by side. Each attempt has a time limit; a failing or late one is repeated, and a row whose attempts
are used up gets an empty text and the error. Counts come from the same pass.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leadloom.operators.frames import quoted
from leadloom.session import materialise

RETRIES = 2
TIMEOUT_S = 60.0
#: Rows of a batch that are called side by side in a task.
AT_ONCE = 4
_LONGEST = 500  # characters of an error that are kept


def attempt(call: Callable[[dict], str | None], row: dict, timeout: float) -> str:
    """The text of one call; its own error, or ``TimeoutError`` when it is late. A late call is left behind, not waited for."""
    got: list = []

    def run() -> None:
        try:
            got.append((call(row), None))
        except Exception as err:  # any error of the call is a result of the row
            got.append((None, err))

    worker = threading.Thread(target=run, daemon=True)
    worker.start()
    worker.join(timeout)
    if not got:
        raise TimeoutError(f"no answer in {timeout:g} s")
    text, error = got[0]
    if error is not None:
        raise error
    if text is None or text == "":
        raise ValueError("empty answer")
    return str(text)


def guarded(call: Callable[[dict], str | None], row: dict, retries: int = RETRIES, timeout: float = TIMEOUT_S, wait: float = 0.0) -> tuple[str, str | None, int]:
    """(text, error, attempts) after at most ``retries`` repetitions, with ``wait``, 2 ``wait``, ... seconds between them."""
    problem = ""
    for i in range(retries + 1):
        if i and wait:
            time.sleep(wait * i)
        try:
            return attempt(call, row, timeout), None, i + 1
        except Exception as err:
            problem = f"{type(err).__name__}: {err}"[:_LONGEST]
    return "", problem, retries + 1


def enriched(
    df: DataFrame, call: Callable[[dict], str | None], cols: Sequence[str], out: str = "pitch", retries: int = RETRIES,
    timeout: float = TIMEOUT_S, wait: float = 0.0, at_once: int = AT_ONCE,
) -> DataFrame:
    """``df`` with ``out`` ('' where every attempt failed), ``<out>_error`` (null where one succeeded) and ``<out>_attempts``.

    ``call`` gets a dict of ``cols``, nulls as None, and must be fit to be sent to the tasks. Only those columns leave the
    JVM. A task that is lost repeats its calls; store the result before it is read twice.
    """
    names = list(cols)

    @F.pandas_udf("text string, error string, attempts int")
    def answers(rows: pd.DataFrame) -> pd.DataFrame:
        plain = rows.astype(object).where(rows.notna(), None).to_dict("records")
        with ThreadPoolExecutor(at_once) as pool:
            found = list(pool.map(lambda row: guarded(call, dict(zip(names, row.values(), strict=True)), retries, timeout, wait), plain))
        return pd.DataFrame(found, columns=["text", "error", "attempts"])

    struct = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])
    found = df.withColumn("__answer", answers.asNondeterministic()(struct))
    named = {out: F.col("__answer.text"), f"{out}_error": F.col("__answer.error"), f"{out}_attempts": F.col("__answer.attempts")}
    return found.withColumns(named).drop("__answer")


def enrich(df: DataFrame, call: Callable[[dict], str | None], cols: Sequence[str], out: str = "pitch", **options) -> tuple[DataFrame, dict]:
    """``enriched`` run once and stored, with its counts: rows, failed, attempts."""
    seen = Observation(f"enrichment of {out}")
    failed = F.count_if(F.col(f"{out}_error").isNotNull())
    rows = enriched(df, call, cols, out, **options).observe(
        seen, F.count("*").alias("rows"), failed.alias("failed"), F.coalesce(F.sum(f"{out}_attempts"), F.lit(0)).alias("attempts")
    )
    stored = materialise(rows)
    return stored, dict(seen.get)
