"""Extraction jobs around a caller-supplied model.

The model is never part of this package.  A *model factory* is a picklable,
zero-argument callable returning a model: ``fn(prompt: str) -> str``.  It is
called once per Python worker process and cached there by a digest of the
pickled factory, so clients and weights are never pickled from the driver and
two factories never share a model.  A model with a method
``many(prompts: list[str]) -> list[str]`` gets lists of ``batch_size`` prompts;
if such a call fails, its prompts are tried one by one.  Calls have their own
latency and error; a failed row never stops the batch.

Model calls are expensive and not deterministic: write or checkpoint the
output of ``run_model`` before using it more than once (Spark may recompute a
lost partition, so a call can happen twice; no exactly-once claim is made).
``run_once`` does that and can be continued: a job that died is run again and
calls the model only for what has no committed output.
"""

from __future__ import annotations

import hashlib
import sys
import time
import types
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.commits import BatchStore
from ..schema import INITIAL_BACKOFF_SEC, MAX_BACKOFF_SEC, MAX_RETRIES

# Fixed value: the message of a blank generation.
EMPTY_TRANSCRIPT = "Empty transcript returned"

ModelFactory = Callable[[], Callable[[str], str]]


def factory_key(factory: ModelFactory) -> str:
    """Digest of the pickled factory; made on the driver, it names the model in every worker."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def _model(key: str, factory: ModelFactory) -> Callable[[str], str]:
    """The worker process's model of this factory.

    Functions of this package may reach a task by value, each time with globals
    of their own, so the cache hangs on the interpreter and not on this module.
    """
    models = sys.modules.setdefault("_convometrics_models", types.ModuleType("_convometrics_models")).__dict__
    if key not in models:
        models[key] = factory()
    return models[key]


class Backoff:
    """Retry delay shared by the stages of one sample: starts at 2 s, doubles, capped at 60 s."""

    def __init__(self, sleep: Callable[[float], None] | None = None):
        self.delay = INITIAL_BACKOFF_SEC
        self.waited = 0.0
        self.sleep = sleep or time.sleep

    def wait(self) -> None:
        self.sleep(self.delay)
        self.waited += self.delay
        self.delay = min(self.delay * 2, MAX_BACKOFF_SEC)

    def reset(self) -> None:
        self.delay = INITIAL_BACKOFF_SEC


def with_retries(call: Callable[[], str], backoff: Backoff, attempts: int = MAX_RETRIES,
                 accept: Callable[[str], None] | None = None) -> tuple[str | None, int, str | None]:
    """Up to ``attempts`` tries; wait between tries (not after the last).  -> (result, tries, error).

    ``accept`` raises for a result that counts as a failure.
    """
    for i in range(attempts):
        try:
            out = call()
            if accept:
                accept(out)
            return out, i + 1, None
        except Exception as e:  # noqa: BLE001  (any model failure is retried)
            if i == attempts - 1:
                return None, i + 1, str(e)
            backoff.wait()
    return None, attempts, "no attempts"


def not_blank(reply: str | None) -> None:
    """A generated transcript that is empty once stripped is a failure."""
    if not (reply or "").strip():
        raise ValueError(EMPTY_TRANSCRIPT)


def run_model(df: DataFrame, factory: ModelFactory, key: str, prompt: str,
              retries: int = 1, sleep: Callable[[float], None] | None = None,
              carry: list[str] | None = None, accept: Callable[[str], None] | None = None,
              batch_size: int = 1) -> DataFrame:
    """``key, reply, latency_ms, attempts, model_error`` (+ ``carry`` columns) for every row.

    ``retries > 1`` wraps each call in the X4 policy.  Concurrency is the
    number of partitions of ``df`` (repartition before calling to set it).
    ``carry`` columns pass through unchanged, so callers need no join back.
    ``accept`` raises for replies that count as failures (X3: ``not_blank``).
    The latency of a row of a list call is its share of the call.
    """
    carry = carry or []
    name = factory_key(factory)

    def one(model, p):
        t0 = time.perf_counter()
        reply, n, err = with_retries(lambda: model(p), Backoff(sleep), retries, accept)
        return reply, int(round((time.perf_counter() - t0) * 1000)), n, err

    def several(model, prompts):
        t0 = time.perf_counter()
        try:
            replies = list(model.many(prompts))
            if len(replies) != len(prompts):
                raise ValueError("the model gave another number of replies")
        except Exception:  # noqa: BLE001  (tried one by one)
            return [one(model, p) for p in prompts]
        ms = int(round((time.perf_counter() - t0) * 1000 / len(prompts)))
        out = []
        for p, reply in zip(prompts, replies):
            try:
                if accept:
                    accept(reply)
                out.append((reply, ms, 1, None))
            except Exception as e:  # noqa: BLE001
                out.append(one(model, p) if retries > 1 else (None, ms, 1, str(e)))
        return out

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(name, factory)
        lists = batch_size > 1 and hasattr(model, "many")
        for b in batches:
            prompts = b[prompt].tolist()
            if lists:
                rows = [r for i in range(0, len(prompts), batch_size) for r in several(model, prompts[i : i + batch_size])]
            else:
                rows = [one(model, p) for p in prompts]
            made = pd.DataFrame(rows, columns=["reply", "latency_ms", "attempts", "model_error"], index=b.index)
            yield pd.concat([b[[key]], made, b[carry]], axis=1)

    key_type = df.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, reply string, latency_ms bigint, attempts int, model_error string"
    schema += "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in carry)
    return df.select(key, prompt, *carry).mapInPandas(fn, schema)


def run_once(df: DataFrame, keys: list[str], inputs: list[str], path: str, call: Callable[[DataFrame], DataFrame], chunks: int = 1) -> DataFrame:
    """``call(df)`` with its outputs kept under ``path``, so that the same job run again goes on where it ended.

    ``call`` makes the outputs of some rows of ``df``; they must hold ``keys``, which
    tell the rows apart.  The rows are dealt by key to ``chunks`` jobs; each one's
    outputs count once its commit is written.  A later run takes the rows that
    have no committed output by an anti-join on the keys and a digest of the
    ``inputs`` (``_asked``, which ``call`` carries; a changed prompt is asked anew),
    so at most the calls of one chunk are repeated.  Returns the outputs of the rows of ``df``.
    """
    spark = df.sparkSession
    store = BatchStore(spark, path)
    asked = df.withColumn("_asked", F.md5(F.to_json(F.struct(*inputs))))
    same = [*keys, "_asked"]

    def missing(done: DataFrame | None) -> DataFrame:
        if done is None:
            return asked
        known = done.select(*[F.col(c).alias(f"_done_{c}") for c in same])
        on = [F.col(c).eqNullSafe(F.col(f"_done_{c}")) for c in same]
        return asked.join(known, on, "left_anti")

    left = missing(store.read())
    chunk = F.pmod(F.xxhash64(*same), F.lit(chunks))
    run = uuid.uuid4().hex
    for i in range(chunks):
        todo = left.filter(chunk == i) if chunks > 1 else left
        made = call(todo)
        if "_asked" not in made.columns:
            raise ValueError("call must carry the column _asked")
        store.write(made, f"{run}-{i}")
    wanted = asked.select(*[F.col(c).alias(f"_want_{c}") for c in same])
    on = [F.col(c).eqNullSafe(F.col(f"_want_{c}")) for c in same]
    return store.read().join(wanted, on, "left_semi").drop("_asked")


def run_stages(df: DataFrame, key: str, prompt: str, stages: list[tuple], sleep: Callable[[float], None] | None = None,
               outputs: bool = False, carry: list[str] | None = None) -> DataFrame:
    """X4 for a multi-stage sample (generation -> extraction): each stage gets up to 5 tries,
    the backoff carries from one stage into the next and resets per sample.  The
    output of stage i is the input of stage i+1.

    ``stages``: (name, factory[, accept[, prepare]]) -- ``accept`` raises for
    outputs that count as failures, ``prepare`` turns the stage's input into the
    model's prompt.

    -> ``key, status, <stage>_attempts..., waited_sec, output, error``; with
    ``outputs`` also ``<stage>_output``.  ``carry`` columns pass through unchanged.
    """
    carry = carry or []
    names = [s[0] for s in stages]
    keys = [factory_key(s[1]) for s in stages]
    columns = [key, "status", *[f"{n}_attempts" for n in names], "waited_sec", "output", "error"]
    columns += [f"{n}_output" for n in names] if outputs else []

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [_model(k, s[1]) for k, s in zip(keys, stages)]
        for b in batches:
            rows = []
            for k, p in zip(b[key].tolist(), b[prompt].tolist()):
                bo = Backoff(sleep)
                cur, row = p, {key: k, "status": "ok", "error": None, **{f"{n}_attempts": 0 for n in names}}
                for (n, _, *rest), m in zip(stages, models):
                    accept = rest[0] if rest else None
                    asked = rest[1](cur) if len(rest) > 1 else cur
                    out, t, e = with_retries(lambda c=asked, m=m: m(c), bo, accept=accept)
                    row[f"{n}_attempts"], row[f"{n}_output"] = t, out
                    if e is not None:
                        row["status"], row["error"], cur = f"{n}_failed", e, None
                        break
                    cur = out
                row["waited_sec"], row["output"] = float(bo.waited), cur
                bo.reset()
                rows.append(row)
            yield pd.concat([pd.DataFrame(rows, columns=columns, index=b.index), b[carry]], axis=1)

    key_type = df.schema[key].dataType.simpleString()
    schema = (
        f"{key} {key_type}, status string, "
        + "".join(f"{n}_attempts int, " for n in names)
        + "waited_sec double, output string, error string"
        + ("".join(f", {n}_output string" for n in names) if outputs else "")
        + "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in carry)
    )
    return df.select(key, prompt, *carry).mapInPandas(fn, schema)


def no_sleep(_: float) -> None:
    """Injected sleep for tests and dry runs: records nothing, waits nothing."""
