"""Fill-in-middle transformation of texts, cut by an indexable skip list.

A text is a list of tokens (a word with the white space before it; white space at the end is one too).
Two hashed ranks cut it into prefix, middle and suffix. Each text becomes a skip list whose express lanes carry, for each
node, how many tokens (units) and how many code points it spans. A lane is made from the one below it by adding up the
widths between promoted nodes, so a rank is found from the top lane down, and the code points passed are its place in the text: both cuts
are exact, at any text length, in a number of steps that grows with the logarithm of the tokens.

``fim_transform`` gives the texts themselves; ``restored`` rebuilds the exact text from an output and its form, as an
expression. Rows are independent: no shuffle, and a lost task is simply run again.

Rows: a NULL text is empty and stays plain; an empty text is plain; a text that holds a sentinel is plain; a NULL
doc_id is hashed as if it had no digits; equal rows give equal rows (a draw depends on the doc_id alone), so there are no ties;
texts are read whole, in slices of code points; an empty table gives an empty result. Only ``doc_id`` and ``text`` are
read, so extra columns of any name do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class FimParams:
    """Seed of the draws, shares in percent, and the sentinels before prefix, suffix and middle."""

    seed: int = 42
    fim_percent: int = 50
    spm_percent: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


#: Code points that are looked at together.
SLICE = 1 << 20
#: Characters of outputs that leave a task together.
TOGETHER = 1 << 23
#: One node in so many is promoted to the next lane.
FANOUT = 4


def token_widths(text: str, size: int = SLICE) -> np.ndarray:
    """Code points of each token. A token ends where a word does; white space after the last word is one token."""
    ends = []
    for at in range(0, len(text), size):
        # one code point more, to see whether a word goes on
        points = np.frombuffer(text[at : at + size + 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        space = (points == 32) | ((points >= 9) & (points <= 13))
        after = np.append(space[1:], True) if at + size >= len(text) else space[1:]
        ends.append(np.flatnonzero(~space[: len(after)] & after) + (at + 1))
    if not ends:
        return np.empty(0, np.int64)
    found = np.concatenate(ends)
    if not len(found) or found[-1] < len(text):
        found = np.append(found, len(text))
    return np.diff(found, prepend=0)


class SkipList:
    """Express lanes over tokens; each node of a lane carries its width in units and in code points."""

    def __init__(self, widths: np.ndarray, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        self.units = [np.ones(len(widths), np.int64)]
        self.points = [np.asarray(widths, np.int64)]
        self.below: list[np.ndarray] = []
        while len(self.units[-1]) > FANOUT:
            up = draw.integers(FANOUT, size=len(self.units[-1])) == 0
            up[0] = True  # the head is in every lane
            starts = np.flatnonzero(up)
            self.units.append(np.add.reduceat(self.units[-1], starts))
            self.points.append(np.add.reduceat(self.points[-1], starts))
            self.below.append(starts)

    def place(self, rank: int) -> int:
        """Code points before the token of this rank (all of them for the rank after the last)."""
        at = node = 0
        for lane in range(len(self.units) - 1, -1, -1):
            units, points = self.units[lane], self.points[lane]
            while node < len(units) and units[node] <= rank:
                rank -= int(units[node])
                at += int(points[node])
                node += 1
            if node == len(units):  # the lane's end is the text's end
                break
            if lane:
                node = int(self.below[lane - 1][node])
        return at


def draws(doc_id: int | None, params: FimParams) -> list[int]:
    """h1 to h4: the first four groups of eight hexadecimal digits."""
    name = hashlib.sha256(f"{params.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(name[k : k + 8], 16) for k in (0, 8, 16, 24)]


def transformed(doc_id: int | None, text: str | None, params: FimParams) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    widths = token_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(doc_id, params)
    marked = any(mark in text for mark in (params.prefix, params.suffix, params.middle))
    if not text or marked or h3 % 100 >= params.fim_percent:
        return n, PLAIN, None, None, text
    lanes = SkipList(widths)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lanes.place(first), lanes.place(second)
    prefix, middle, suffix = params.prefix + text[:a], params.middle + text[a:b], params.suffix + text[b:]
    if h4 % 100 < params.spm_percent:
        return n, SPM, a, b - a, suffix + prefix + middle
    return n, PSM, a, b - a, prefix + suffix + middle


def fim_transform(docs: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            made = pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )
            rows.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc_id = doc.as_py()
                rows.append((doc_id, *transformed(doc_id, text.as_py(), params)))
                held += len(rows[-1][-1]) + 64
                if held > TOGETHER:
                    yield out()
                    held = 0
        if rows:
            yield out()

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, schema)


def restored(output: Column, form: Column, params: FimParams = FimParams()) -> Column:
    """The text that an output was made of. A transformed text holds no sentinel of its own, so each stands once."""

    def between(after: str, before: str | None) -> Column:
        rest = F.split_part(output, F.lit(after), F.lit(2))
        return rest if before is None else F.split_part(rest, F.lit(before), F.lit(1))

    psm = F.concat(
        between(params.prefix, params.suffix), between(params.middle, None), between(params.suffix, params.middle)
    )
    spm = F.concat(between(params.prefix, params.middle), between(params.middle, None), between(params.suffix, params.prefix))
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)


def fim_digests(docs: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """``fim_transform`` with digests of the outputs and of the texts rebuilt from them."""
    made = fim_transform(docs, params)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), params), 256).alias("restored_sha256"),
    )


def fim_sql(params: FimParams = FimParams()) -> str:
    """DuckDB SQL of ``fim_digests``: tokens as lists, cut by slices; the rebuilt text is the text."""
    marked = " OR ".join(f"contains(text, '{mark}')" for mark in (params.prefix, params.suffix, params.middle))
    part = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT AS h{k + 1}"
    return rf"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{params.seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), t AS (
  SELECT doc_id, text, {", ".join(map(part, range(4)))},
    regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM u
), c AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b FROM t
), f AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR {marked} OR h3 % 100 >= {params.fim_percent} THEN 'plain'
      WHEN h4 % 100 < {params.spm_percent} THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '{params.prefix}' || p || '{params.suffix}' || s || '{params.middle}' || m
    ELSE '{params.suffix}' || s || '{params.prefix}' || p || '{params.middle}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f"""
