"""Language identification by cross-parsing entropy.

For each language the suffix automaton of a sample of labelled text is built.  A text is parsed greedily into the longest phrases
that occur in that sample: a phrase ends where the automaton has no further step.  A language's cost is its number of
phrases times log2 of its sample's length (the bits that point at a phrase), over the text's symbols; the least cost wins.

The ``SINGLES`` most common letters of the samples are symbols of their own; any other letter is written as three, digits of its code point, so
letters of wide scripts count as well.  Whole texts are parsed, each from its first symbol to its last.  So that numpy steps through many places of a text at once, it is cut into blocks
of ``BLOCK`` symbols that are first parsed as if each began a text; then blocks whose predecessor ends in another state are parsed again from that state, until they meet
the states of the earlier parse, from where on both are the same.  Parses that began apart meet after a few phrases.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import sent, small_batches

#: The training sample: rows with the smallest hashes of id and text in each language, and symbols of them in all.
SAMPLE_ROWS = 300
SAMPLE_SYMBOLS = 40_000
BLOCK = 256
#: Texts are parsed together while they hold so many characters at most, or one by one, so that a worker's memory doesn't follow the size of a batch.
TOGETHER = 1 << 19
#: Rounds in which all blocks are parsed again whose entry has changed.
ROUNDS = 4
#: Symbols: a space (everything that isn't a letter), digits that no sample has, the most common letters, the samples' digits, a filler.
SPACE, OTHER, SINGLES = 0, 1, 120
_WIDE = 255
#: The sample is taken in so many parts of each language first.
_PARTS = 64
_BREAK = 1 << 30


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)


def squeezed(sym: np.ndarray) -> np.ndarray:
    """Without spaces that follow a space or begin the text."""
    keep = sym != SPACE
    keep[1:] |= sym[:-1] != SPACE
    return sym[keep]


def automaton(sym: list[int], width: int) -> np.ndarray:
    """Steps of the suffix automaton, flat: cell state + symbol holds the next state, both times width.

    A missing step holds the root's step with the flag _BREAK: a new phrase begins.  The last state is where a text and what follows
    an unknown symbol start: all its steps begin a phrase.  The last symbol of the alphabet is padding and stays.
    """
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sym:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = copy
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
        last = new
    root = np.full(width, (len(step) * width) | _BREAK, dtype=np.int32)
    for c, t in step[0].items():
        root[c] = (t * width) | _BREAK
    table = np.tile(root, (len(step) + 1, 1))
    table[-1, -1] = len(step) * width
    for s, row in enumerate(step):
        for c, t in row.items():
            table[s, c] = t * width
        table[s, width - 1] = s * width
    return table.ravel()


def phrases(grid: np.ndarray, owner: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    """Phrases that begin in each column of grid, a block of BLOCK symbols; a text's blocks follow each other, and owner numbers the text of each.

    After ROUNDS rounds over all blocks that are entered otherwise, only a text's first such block is parsed, as its entry is final: so no text
    takes more steps than its length, though periodic ones may never meet an earlier parse.
    """
    follows = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    start = len(table) - width
    count = np.zeros(grid.shape[1], dtype=np.int32)
    reached = np.empty(grid.shape, dtype=np.int32)
    state = np.full(grid.shape[1], start, dtype=np.int32)
    for row, new in zip(grid, reached, strict=True):
        state += row
        new[:] = table[state]
        count += new >> 30
        np.bitwise_and(new, _BREAK - 1, out=state)
    entered = np.full(grid.shape[1], start, dtype=np.int32)
    for done in itertools.count():
        state = reached[-1, follows - 1] & (_BREAK - 1)
        apart = entered[follows] != state
        at, state = follows[apart], state[apart]
        if not len(at):
            break
        if done >= ROUNDS:
            first = np.unique(owner[at], return_index=True)[1]
            at, state = at[first], state[first]
        entered[at] = state
        for row, old in zip(grid, reached, strict=True):
            new = table[state + row[at]]
            count[at] += (new >> 30) - (old[at] >> 30)
            state = new & (_BREAK - 1)
            going = state != old[at] & (_BREAK - 1)
            old[at] = new
            at, state = at[going], state[going]
            if not len(at):
                break
    return count


class Model:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, list[str]], sample_symbols: int = SAMPLE_SYMBOLS) -> None:
        self.langs = sorted(samples)
        lower = {k: [t.lower() for t in v] for k, v in samples.items()}
        count: dict[str, int] = {}
        for v in lower.values():
            for t in v:
                for c in filter(str.isalpha, set(t)):
                    count[c] = count.get(c, 0) + 1
        letters = sorted(sorted((c for c in count if ord(c) < 0x10000), key=lambda c: (-count[c], c))[:SINGLES])
        used = sorted({ord(c) >> (14 - 7 * k) & 127 for c in set(count) - set(letters) for k in range(3)})
        self.table = np.where(_letters(), _WIDE, SPACE).astype(np.uint8)
        self.table[[ord(c) for c in letters]] = np.arange(len(letters)) + 2
        self.digits = np.full(128, OTHER, dtype=np.uint8)
        self.digits[used] = np.arange(len(used)) + 2 + len(letters)
        self.width = len(letters) + len(used) + 3
        self.tables, self.bits = [], []
        for lang in self.langs:
            sym = squeezed(self.symbols(" ".join(lower[lang]))[0])[:sample_symbols]
            self.tables.append(automaton(sym.tolist(), self.width))
            self.bits.append(float(np.log2(max(2, len(sym)))))

    def symbols(self, text: str) -> tuple[np.ndarray, np.ndarray | None]:
        """Symbols of a text or of several texts end to end, as uint8, and how many each character has; none if all have one."""
        code = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        if len(code) and code.max() > 0xFFFF:
            far = code > 0xFFFF
            sym = self.table[np.where(far, 0, code)]
            sym[far] = [_WIDE if chr(c).isalpha() else SPACE for c in code[far].tolist()]
        else:
            sym = self.table[code]
        wide = sym == _WIDE
        if not wide.any():
            return sym, None
        many = np.where(wide, 3, 1)
        at = (np.cumsum(many) - many)[wide]
        sym = np.repeat(sym, many)
        for k in range(3):
            sym[at + k] = self.digits[code[wide] >> (14 - 7 * k) & 127]
        return sym, many

    def parsed(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each text has a letter, and its phrases in each language (a row for each language)."""
        lower = [(t or "").lower() for t in texts]
        sym, many = self.symbols("".join(lower))
        owner = np.repeat(np.arange(len(lower), dtype=np.int32), np.fromiter(map(len, lower), dtype=np.int64, count=len(lower)))
        if many is not None:
            owner = np.repeat(owner, many)
        keep = sym != SPACE
        keep[1:] |= (sym[:-1] != SPACE) & (owner[1:] == owner[:-1])
        has_letter = np.bincount(owner, weights=sym != SPACE, minlength=len(lower)) > 0
        sym, owner = sym[keep], owner[keep]
        size = np.bincount(owner, minlength=len(lower))
        blocks = -(-size // BLOCK)
        first = np.concatenate(([0], np.cumsum(blocks)))
        inside = np.arange(len(sym)) - np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
        grid = np.full((BLOCK, int(first[-1])), self.width - 1, dtype=np.uint8)
        grid[inside % BLOCK, first[:-1][owner] + inside // BLOCK] = sym
        of_block = np.repeat(np.arange(len(lower)), blocks)
        found = [np.bincount(of_block, weights=phrases(grid, of_block, table, self.width), minlength=len(lower)) for table in self.tables]
        return has_letter, np.array(found).reshape(len(self.langs), len(lower))

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language (und: null or without a letter) and score of each text: how much less the winner costs than the next, from 0 to 1."""
        langs, scores, first, size = [], [], 0, 0
        for i, t in enumerate([*texts, None]):
            size += len(t or "")
            if i == len(texts) or (size > TOGETHER and i > first):
                one, two = self._score(texts[first:i])
                langs += one
                scores += two
                first, size = i, len(t or "")
        return langs, scores

    def _score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        has_letter, found = self.parsed(texts)
        cost = found * np.array(self.bits).reshape(-1, 1)
        best = cost.argmin(axis=0) if self.langs else np.zeros(len(texts), dtype=int)
        ranked = np.sort(cost, axis=0)
        langs, scores = [], []
        for i, ok in enumerate(has_letter.tolist()):
            langs.append(self.langs[best[i]] if ok and self.langs else "und")
            scores.append(0.0 if not ok or not self.langs else 1.0 if len(self.langs) == 1 else float(1 - ranked[0, i] / ranked[1, i]))
        return langs, scores


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, sample_symbols: int = SAMPLE_SYMBOLS) -> Model:
    """A model from the labelled rows of df: sample_rows rows and sample_symbols symbols for each language at most.

    The rows are those with the smallest hashes of their ids.  Null languages, null ids, null texts and texts without a letter teach nothing; rows with equal ids and languages
    count as one, with the least text.  Without a labelled row every text is und.
    """
    lang = F.col(lang_col).cast("string").alias("lang")
    rows = df.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(lang, F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h"))
    rows = rows.withColumn("part", F.pmod("h", F.lit(_PARTS)))
    for by in (["lang", "part"], ["lang"]):
        rows = rows.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("h", "id"))).where(F.col("k") <= sample_rows).drop("k")
    top = rows.select("lang", "id", "h").distinct()
    whole = df.select(lang, F.col(id_col).alias("id"), F.substring(text_col, 1, 4 * sample_symbols).alias("text")).where(F.col("text").isNotNull())
    got = whole.join(F.broadcast(top), ["lang", "id"]).groupBy("lang", "id", "h").agg(F.min("text").alias("text")).select("lang", "text", "h").collect()
    samples: dict[str, list[str]] = {}
    used: dict[str, int] = {}
    for lang, text, _ in sorted(got, key=lambda r: (r[2], r[0], r[1])):
        if used.get(lang, 0) < 4 * sample_symbols and any(c.isalpha() for c in text):
            samples.setdefault(lang, []).append(text)
            used[lang] = used.get(lang, 0) + len(text)
    return Model(samples, sample_symbols)


def identify(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, and lang_pred and score, for each row.  Columns of these two names in keep are replaced.

    Every row stays; null texts and texts without a letter are und with score 0.  The model is broadcast; its size follows its sample's bound.
    """
    small_batches(df.sparkSession)
    held = sent(df.sparkSession, model)
    keep = tuple(c for c in keep if c.lower() not in ("lang_pred", "score"))
    rest = [c for c in keep if c != text_col]
    whole = text_col in keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held()
        for b in batches:
            lang, score = model.score(b.column(0).to_pylist())
            cols = b.columns[0 if whole else 1 :]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*b.schema.names[0 if whole else 1 :], "lang_pred", "score"])

    rows = df.select(F.col(text_col).alias("__text"), *rest)
    fields = rows.schema.fields[0 if whole else 1 :]
    got = rows.mapInArrow(run, StructType(list(fields)).add("lang_pred", "string").add("score", "double"))
    return got.withColumnRenamed("__text", text_col).select(*keep, "lang_pred", "score") if whole else got
