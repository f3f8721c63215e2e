"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import text_steps
from tollgate.session import ship_package

#: Letter symbols: 0 is the border of a word, 1-26 are a-z, the others share the rest by code point.
SYMBOLS = 64
CODES = SYMBOLS**3
DIMENSIONS = 1024
SEED = 20
#: Languages one model may hold: with CODES, the size bound of what the driver gathers to learn it.
MAX_LANGUAGES = 256
UNKNOWN = "und"


@lru_cache(maxsize=1)
def symbol_of() -> np.ndarray:
    """The symbol of every code point, in lower case; 0 where it is no letter."""
    symbols = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            base = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
            symbols[point] = base
    return symbols


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """One random vector of +1 and -1 for each symbol."""
    bits = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMENSIONS))
    return (2 * bits - 1).astype(np.int8)


def grams(codes: np.ndarray) -> np.ndarray:
    """The vectors of trigrams: the letters' vectors, permuted by their places and bound by products."""
    vectors = letters()
    first = np.roll(vectors, 2, axis=1)[codes // (SYMBOLS * SYMBOLS)]
    second = np.roll(vectors, 1, axis=1)[codes // SYMBOLS % SYMBOLS]
    return (first * second * vectors[codes % SYMBOLS]).astype(np.float32)


def trigrams(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, trigram) of some texts: text number, code and count.

    Everything that is no letter counts as one border between words; a text starts and ends with one.
    """
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    # the first code point of each text: bytes that start a code point, counted up to its border
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[borders]
    of = np.repeat(np.arange(len(borders) - 1), np.diff(begins))
    symbols = np.zeros(len(of), np.uint8)
    symbols[: len(points)] = symbol_of()[points[: len(of)]]
    # a border before each text keeps texts apart
    at = begins[:-1] + np.arange(len(borders) - 1)
    line = np.zeros(len(symbols) + len(borders), np.uint8)
    owner = np.full(len(line), -1, np.int64)
    places = np.arange(len(symbols)) + of + 1
    line[places], owner[places], owner[at] = symbols, of, np.arange(len(borders) - 1)
    owner[-1] = len(borders) - 2
    keep = (line != 0) | np.concatenate(([True], (line[1:] == 0) & (line[:-1] != 0)))
    line, owner = line[keep].astype(np.int64), owner[keep]
    middle = (line[1:-1] != 0) if len(line) > 2 else np.zeros(0, bool)
    code = (line[:-2] * SYMBOLS + line[1:-1]) * SYMBOLS + line[2:]
    keys, counts = np.unique(owner[1:-1][middle] * CODES + code[middle], return_counts=True)
    return keys // CODES, keys % CODES, counts


def bundles(texts: np.ndarray, codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The sum of each text's trigram vectors."""
    used, column = np.unique(codes, return_inverse=True)
    weights = np.zeros((size, len(used)), np.float32)
    weights[texts, column] = counts
    return weights @ grams(used)


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes: the bundled trigrams of all rows that have text and language.

    Tasks count trigrams and Spark adds the counts up by language, so the driver gets at most one
    number per trigram code and language, for at most MAX_LANGUAGES languages (more are an error).
    """
    ship_package(docs.sparkSession)
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch, data, borders in text_steps(batches, "text"):
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            texts, codes, counts = trigrams(data, borders)
            for name in set(names):
                own = (names == name)[texts]
                if name not in totals:
                    if len(totals) == MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    totals[name] = np.zeros(CODES, np.int64)
                np.add.at(totals[name], codes[own], counts[own])
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(total[used])],
                names=["lang", "code", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, code long, n long")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counted.column(0).to_pylist(), dtype=object)
    langs = sorted(set(names))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    codes, counts = counted.column(1).to_numpy(), counted.column(2).to_numpy().astype(np.float32)
    prototypes = np.zeros((len(langs), DIMENSIONS), np.float32)
    for i, name in enumerate(langs):
        own = np.flatnonzero(names == name)
        for first in range(0, len(own), 8192):
            part = own[first : first + 8192]
            prototypes[i] += counts[part] @ grams(codes[part])
    return langs, unit(prototypes)


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The language whose prototype has the largest cosine with a text's own bundle.

    Gives the columns in keep, lang_pred and score: the cosine, or 0 where it is negative. A text
    that is null or has no letter is `und` with score 0, as is every text if nothing was learned.
    Of equal cosines the first language in code-point order wins. Repeated rows are judged singly,
    columns not in keep are not read, no rows give no rows; a column in keep may have any type but
    not the names lang_pred or score; the text itself may be in it.
    """
    ship_package(docs.sparkSession)
    langs, prototypes = model
    rows = docs.select(*dict.fromkeys((*keep, text)))
    fields = rows.schema.fields[: len(keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    compared = prototypes.T.copy()

    def run(batches):
        for batch, data, borders in text_steps(batches, text, 250_000):
            size = len(batch)
            texts, codes, counts = trigrams(data, borders)
            best, score = np.full(size, -1), np.zeros(size)
            if langs and len(codes):
                cosine = unit(bundles(texts, codes, counts, size)) @ compared
                seen = np.unique(texts)
                best[seen] = cosine[seen].argmax(axis=1)
                score[seen] = np.clip(cosine[seen].max(axis=1), 0, 1)
            names = [langs[i] if i >= 0 else UNKNOWN for i in best]
            columns = [batch.column(i) for i in range(len(fields))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(score)],
                names=[*(f.name for f in fields), "lang_pred", "score"],
            )

    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
