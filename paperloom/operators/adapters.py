"""What needs a model or a converter from outside: functions to inject, with plain stand-ins that work offline.

An adapter is a function from a batch of inputs to as many outputs. It runs on Arrow batches, on those rows alone that
nothing cheaper has settled."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VISION = "category string, is_useful boolean, figure_ref string, description string, ocr_text string, error string, attempts int"


class PermanentError(Exception):
    """An error that a further attempt won't mend."""


def apply(df: DataFrame, make: Callable[[], Callable[[list], list]], column: str, out: str, kind: str) -> DataFrame:
    """Adds ``out``. ``make`` builds the function once a task, so that a model is loaded once."""

    returned = T._parse_datatype_string(kind)
    names = returned.fieldNames() if isinstance(returned, T.StructType) else None

    def f(parts):  # type: ignore[no-untyped-def]
        run = make()
        for part in parts:
            made = run(part.tolist())
            yield pd.DataFrame(made, columns=names) if names else pd.Series(made)

    f.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame if names else pd.Series]}
    return df.withColumn(out, F.pandas_udf(f, returned)(F.col(column)))


def residual(df: DataFrame, settled: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``settled`` holds for as they are, and the others through ``work``; no condition in one plan would
    keep a function from running on rows that don't need it."""
    return df.where(settled).unionByName(work(df.where(f"NOT coalesce({settled}, false)")), allowMissingColumns=True)


def with_retries(call: Callable[[str], dict], most: int = 3, shortest: int = 20) -> Callable[[list], list]:
    """A vision call with attempts: transient errors and descriptions that are too short are tried again, permanent ones not."""

    def one(x: str) -> dict:
        found, error, n = {}, None, 0
        while n < most:
            n += 1
            try:
                found, error = call(x), None
                if len(found.get("description") or "") >= shortest or not found.get("is_useful"):
                    break
            except PermanentError as e:
                error, n = type(e).__name__, most
            except Exception as e:
                error = type(e).__name__
        return {k: found.get(k) for k in ("category", "is_useful", "figure_ref", "description", "ocr_text")} | {"error": error, "attempts": n}

    return lambda xs: [one(x) for x in xs]


def extract_json(text: str) -> dict | None:
    """The object in a model's answer, with or without a fence or words round it."""
    t = (text or "").strip().strip("`").removeprefix("json").strip()
    for part in (t, *(m.group(0) for m in [re.search(r"\{.*\}", t, re.S)] if m)):
        try:
            return json.loads(part)
        except ValueError:
            pass
    return None


def stub_vision(image: str) -> dict:
    """A stand-in: the category by the picture's hash."""
    h = hashlib.sha256((image or "").encode()).digest()
    return {"category": ("schematic", "nameplate", "decorative")[h[0] % 3], "is_useful": h[0] % 3 < 2, "figure_ref": "", "description": f"A picture with the hash {h.hex()[:16]}", "ocr_text": ""}


def stub_embedding(texts: list[str], dims: int = 64) -> list[list[float]]:
    """A stand-in: hashed words, normalised."""
    out = []
    for t in texts:
        v = [0.0] * dims
        for w in re.findall(r"\w+", (t or "").lower()):
            h = hashlib.md5(w.encode()).digest()
            v[h[0] % dims] += 1 if h[1] % 2 else -1
        n = sum(x * x for x in v) ** 0.5 or 1.0
        out.append([x / n for x in v])
    return out


def summary_prompt(titles: list[str], body: str, most: int = 40, chars: int = 20_000) -> str:
    return "\n".join([*(f"- {t}" for t in titles[:most]), body[:chars]])


def stub_summary(prompts: list[str]) -> list[str]:
    """A stand-in: the first sentences."""
    return [" ".join(re.split(r"(?<=[.!?])\s+", (p or "").strip())[:3]) for p in prompts]


def difference_hash(pixels: list[list[int]]) -> str:
    """64 bits of a grey picture of 8 rows of 9: whether each pixel is darker than the next."""
    bits = "".join("1" if row[i] > row[i + 1] else "0" for row in pixels for i in range(8))
    return f"{int(bits, 2):016x}"


def luminance_class(histogram: list[int]) -> str:
    """A guess from 256 counts of brightness: line art is mostly light with some dark and little between."""
    total = sum(histogram) or 1
    dark, light = sum(histogram[:64]) / total, sum(histogram[192:]) / total
    return "line_art" if light > 0.6 and dark > 0.01 and 1 - dark - light < 0.25 else "photo"


def passthrough_converter(content: bytes, name: str) -> bytes:
    """A stand-in for a converter of office files: what comes in goes out."""
    return content
