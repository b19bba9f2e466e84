"""Fill-in-the-middle: texts cut at two token boundaries and rearranged.

A token is a run of ASCII letters or one other character.  The places where a
text's tokens end are held as a set of integers in the manner of Roaring
bitmaps: offsets are split by their high bits into chunks of 65,536, and each
chunk is kept in the smallest of three containers, a sorted array (few ends, as
in a short text), a bitmap (long prose) or runs (digits, spaces, scripts without
ASCII letters, where every place is an end).  Containers carry cumulative
cardinalities: the k-th end is found by a search for its container and a select
inside it, without a list of all ends.

Which texts are rearranged, in which form and where they are cut depends on the
id alone, by SHA-256, so reruns and lost tasks give the same rows.  The work is
one map over the rows, without a shuffle.

Defined results: a null text is the empty text, and stays plain; whole texts
are cut; a text that holds a marker stays plain, since it could not be restored;
a null id counts as the empty string in the hash; repeated rows are each
treated alike; equal cuts give an empty middle; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
#: Markers before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


# -- the set of boundaries -----------------------------------------------------

class ArrayContainer:
    """Members as sorted 16-bit numbers."""

    def __init__(self, member: np.ndarray):
        self.low = np.flatnonzero(member).astype(np.uint16)

    @staticmethod
    def cost(members: int, runs: int) -> int:
        return 2 * members

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit a place, and how many members precede each 1,024 bits."""

    BLOCK = 128  # bytes

    def __init__(self, member: np.ndarray):
        bits = np.zeros(CHUNK, bool)
        bits[:len(member)] = member
        self.bytes = np.packbits(bits)
        each = bits.reshape(-1, 8 * self.BLOCK).sum(1)
        self.before = np.concatenate([[0], each.cumsum()[:-1]]).astype(np.uint16)

    @staticmethod
    def cost(members: int, runs: int) -> int:
        return CHUNK // 8

    def select(self, k: int) -> int:
        block = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.bytes[block * self.BLOCK:(block + 1) * self.BLOCK])
        return block * 8 * self.BLOCK + int(np.flatnonzero(bits)[k - int(self.before[block])])


class RunContainer:
    """Runs of neighbouring members: first member, and members before the run."""

    def __init__(self, member: np.ndarray):
        edges = np.flatnonzero(np.diff(member.astype(np.int8), prepend=0, append=0))
        self.first = edges[::2].astype(np.uint16)
        length = edges[1::2] - edges[::2]
        self.before = np.concatenate([[0], length.cumsum()[:-1]]).astype(np.uint16)

    @staticmethod
    def cost(members: int, runs: int) -> int:
        return 4 * runs

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


class BoundarySet:
    """A set of offsets below the length of ``member``, which says for each
    offset whether it belongs."""

    def __init__(self, member: np.ndarray):
        self.containers: list[tuple[int, ArrayContainer | BitmapContainer | RunContainer]] = []
        ends = [0]
        for at in range(0, len(member), CHUNK):
            part = member[at:at + CHUNK]
            n = int(np.count_nonzero(part))
            if n:
                runs = int(part[0]) + int(np.count_nonzero(part[1:] & ~part[:-1]))
                kind = min((ArrayContainer, RunContainer, BitmapContainer), key=lambda c: c.cost(n, runs))
                self.containers.append((at, kind(part)))
                ends.append(ends[-1] + n)
        self.cumulative = np.array(ends, np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, k: int) -> int:
        """The member that ``k`` others precede."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.cumulative, k, "right")) - 1
        base, container = self.containers[at]
        return base + container.select(k - int(self.cumulative[at]))


def token_ends(text: str) -> BoundarySet:
    """The offset of every token's last character, in code points."""
    code = np.frombuffer(text.encode("latin-1"), np.uint8) if text.isascii() else np.frombuffer(
        text.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Setting bit 5 makes A-Z a-z of letters; what is below A wraps to large numbers.
    letter = ((code | 32) - code.dtype.type(97)) < 26
    end = ~letter
    end[:-1] |= end[1:]
    if len(end):
        end[-1] = True
    return BoundarySet(end)


# -- the transformation ----------------------------------------------------------

def transform(doc_id: str | int | None, text: str | None, seed: int = 1, fim_share: int = 90,
              spm_share: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """(tokens, form, code points of the prefix and of the middle, output)."""
    text = text or ""
    ends = token_ends(text)
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_share:
        return n, "plain", None, None, text
    a, b = (ends.select(k - 1) + 1 if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_share:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 1, fim_share: int = 90, spm_share: int = 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the whole output of every document."""
    columns = ["key", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch["key"], batch["text"], strict=True):
                rows.append((key, *transform(key, text, seed, fim_share, spm_share)))
                size += len(rows[-1][-1])
                if size > 8_000_000:
                    yield frame(rows)
                    rows, size = [], 0
            yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns, dtype=object)
        return out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    # The id travels as text: pandas makes floats of numbers beside nulls.
    made = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text")).mapInPandas(
        run, "key string, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.select(F.col("key").cast(docs.schema[id_col].dataType).alias("doc_id"), *columns[1:])


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, by its markers.

    The first of each marker is the right one: texts with a marker stay plain,
    and no marker can arise across a cut, since only its first character is ``<``."""
    out, kind = F.col(output), F.col(form)

    def between(first: str, then: str) -> Column:
        start = F.length(F.lit(first)) + 1
        end = F.locate(then, out)
        return F.substring(out, start, end - start)

    def after(mark: str, stop: str | None = None) -> Column:
        start = F.locate(mark, out) + len(mark)
        return F.substring(out, start, F.length(out) if stop is None else F.locate(stop, out) - start)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), after(SUFFIX, MIDDLE))
    spm = F.concat(after(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(out)
