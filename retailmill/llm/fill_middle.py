"""Fill-in-the-middle: a text is cut in three and its middle moved to the end.

Cuts lie between units (lines, or sentences). Each character has a class, and a wavelet
matrix over the classes of many texts answers how often a class occurs before a position.
The units before a position are the sum of the ranks of the classes that end one; the
place after the u-th unit is found by select (one such class) or by bisection on ranks
(several). Which cuts and which order a document gets follows from a hash of its id, so
a repeated task gives the same output.

Forms: ``psm`` <P>prefix<S>suffix<M>middle, ``spm`` <S>suffix<P>prefix<M>middle, ``plain``
the text itself: where it is empty, holds one of the three marks, or is not drawn by
``Settings.percent``. No mark can arise at a seam, as none begins the way another ends;
so ``restore`` splits at the marks and is exact.

One pass, no shuffle. Texts are worked on in groups of half a million bytes; a
longer one is a group of its own, at about 40 bytes a character.

Defined cases: null and empty texts are plain and empty; equal rows have equal results; a
null id hashes as the seed alone; one unit may leave two of the three parts empty; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retailmill.llm.common import groups_of_rows, texts
from retailmill.llm.wavelet import WaveletMatrix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Character classes.
OTHER, NEWLINE, STOP, MARK = 0, 1, 2, 3
DEPTH = 2
#: The classes whose characters end a unit.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, STOP)}


@dataclass(frozen=True)
class Settings:
    unit: str = "line"
    seed: str = "7:"
    percent: int = 100
    spm_percent: int = 50


def classes(points: np.ndarray) -> np.ndarray:
    """The class of each code point."""
    out = np.zeros(len(points), np.uint8)
    out[points == ord("\n")] = NEWLINE
    out[np.isin(points, [ord(c) for c in ".!?"])] = STOP
    out[points == ord("<")] = MARK
    return out


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Units:
    """Units of many texts, stored back to back."""

    def __init__(self, text: list[str], unit: str):
        self.enders = UNITS[unit]
        codes = classes(points_of("".join(text)))
        self.matrix = WaveletMatrix(codes, DEPTH)
        stops = np.cumsum([0, *map(len, text)]).astype(np.int64)
        self.begin, self.end = stops[:-1], stops[1:]
        self.before = self.matrix.rank_of(self.enders, self.begin)
        self.ended = self.matrix.rank_of(self.enders, self.end) - self.before
        last = np.maximum(self.end - 1, self.begin)
        closed = self.matrix.rank_of(self.enders, self.end) > self.matrix.rank_of(self.enders, last)
        #: number of units of each text; what follows the last ender is one, too
        self.n = self.ended + ((self.end > self.begin) & ~closed)

    def after(self, units: np.ndarray) -> np.ndarray:
        """For each text the number of characters that its first ``units`` units take."""
        inner = (units > 0) & (units < self.n)
        at = np.where(units > 0, self.end - self.begin, 0)
        if inner.any():
            k = self.before[inner] + units[inner] - 1
            at[inner] = self.matrix.select_of(self.enders, k) + 1 - self.begin[inner]
        return at


def _draws(seed: str) -> Column:
    """Four unsigned 32-bit numbers from the hash of an id."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output of every row."""
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, text, drawn in groups_of_rows(batches):
            units = Units(text, settings.unit)
            h = np.array(drawn, np.int64).reshape(-1, 4)
            a, b = (h[:, k] % (units.n + 1) for k in (0, 1))
            first, second = units.after(np.minimum(a, b)), units.after(np.maximum(a, b))
            plain = h[:, 2] % 100 >= settings.percent
            plain |= [not t or PREFIX in t or SUFFIX in t or MIDDLE in t for t in text]
            spm = h[:, 3] % 100 < settings.spm_percent
            form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
            output = [
                t if f == "plain"
                else f"{SUFFIX}{t[q:]}{PREFIX}{t[:p]}{MIDDLE}{t[p:q]}" if f == "spm"
                else f"{PREFIX}{t[:p]}{SUFFIX}{t[q:]}{MIDDLE}{t[p:q]}"
                for t, f, p, q in zip(text, form, first.tolist(), second.tolist())
            ]
            cells = (
                pa.array(ids, pa.int64()), pa.array(units.n), pa.array(form.tolist(), pa.string()),
                pa.array(first, mask=plain), pa.array(second - first, mask=plain), pa.array(output, pa.string()),
            )
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cells, arrow)], schema=arrow)

    return texts(docs).withColumn("drawn", _draws(settings.seed)).mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    part = F.split(output, "<[PSM]>")
    psm = F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2))
    spm = F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The transformation with the digests of output and restored text in place of the texts."""
    rows = fill_in_middle(docs, settings)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
