"""Best-fit packing by length patterns and non-negative least squares.

Texts become tokens; longer ones are cut into full pieces. The histogram of
piece lengths (at most `capacity` numbers, whatever the data) is all the driver
plans with: patterns of a few lengths that fill a sequence, repeat counts fitted to
the histogram, rounded down, the rest packed best-fit decreasing. Pieces are then
ranked within their length over many tasks and look their place up in the plan.

Edges: a null text is an empty one, an empty text is one piece of the closing id
alone; repeated rows and ids are pieces of their own; a null doc_id is kept; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, text_rows, written

CAPACITY = 4096
CLOSING_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Pieces of one length that one task ranks, about.
RANK_ROWS = 256
#: Characters of texts whose words are looked up together, about.
SLICE_CHARS = 1_000_000
#: Lengths tried as further members of a pattern.
PARTNERS = 24


# -- tokens --------------------------------------------------------------------

def _plain_class(kinds: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x20, 0x180) if unicodedata.category(chr(c))[0] in kinds)


class WordTokens:
    """The tokenizer's ids, word by word from a bounded memory.

    Texts of plain Latin letters are cut by the tokenizer's own rule and each word is
    encoded once; any other text goes through the tokenizer whole.
    """

    MEMORY = 400_000  # about 80 MB

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.last = np.zeros(self.whole.get_vocab_size(), dtype=bool)  # ids that end a word
        for token, i in self.whole.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        letters, numbers = _plain_class("L"), _plain_class("N")
        # fixed value: the tokenizer's own splitting pattern, over the plain range; letters first, as no ending begins with one
        self.words = re.compile(f"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{letters}{numbers}]+").findall
        # characters on which case, white space and composition rules of all libraries agree; no special-token bracket
        self.plain = re.compile("(?:[\t\n\r\x20-\x7e\xa1-įĲ-ňŊ-ſ])*").fullmatch

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The same of many texts, whose new words are encoded together."""
        out, cut = [b""] * len(texts), {}
        for i, text in enumerate(texts):
            if "<|" in text or not self.plain(text):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            else:
                cut[i] = self.words(text.lower())
        if len(self.ids) > self.MEMORY:  # words not met again for so long are forgotten
            self.old, self.ids = self.ids, {}
        missing = set().union(*cut.values()).difference(self.ids)
        old = self.old
        self.ids.update([(w, old[w]) for w in missing if w in old])
        self._learn([w for w in missing if w not in old])
        known = self.ids.__getitem__
        for i, words in cut.items():
            out[i] = b"".join(map(known, words))
        return out

    def _learn(self, new: list[str]) -> None:
        """Encode new words as one text and cut its ids where words end."""
        if not new:
            return
        got = np.array(self.whole.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.last[got]) + 1
        if len(stops) != len(new):  # a word that the tokenizer cuts further
            for w in new:
                self.ids[w] = np.array(self.whole.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
            return
        raw, ends = got.tobytes(), (stops * 4).tolist()
        self.ids.update(zip(new, [raw[a:b] for a, b in zip([0, *ends], ends)]))


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    path = path or public_tokenizers.path(TOKENIZER)
    closing = np.array([CLOSING_ID], dtype="<u4").tobytes()

    tokens: list[WordTokens] = []  # one per task, freed with it

    def run(f: pd.DataFrame) -> pd.DataFrame:
        if not tokens:
            tokens.append(WordTokens(path))
        rows = []
        texts = f["text"].tolist()
        turn = np.cumsum([len(t) for t in texts]) // SLICE_CHARS
        cuts = [0, *(np.flatnonzero(turn[1:] != turn[:-1]) + 1).tolist(), len(texts)]
        ids = (x for a, b in zip(cuts, cuts[1:]) for x in tokens[0].encode_all(texts[a:b]))
        for doc_id, found in zip(f["doc_id"], ids):
            found += closing
            for k, at in enumerate(range(0, len(found), 4 * capacity)):
                cut = found[at:at + 4 * capacity]
                rows.append((doc_id, k, k * capacity, len(cut) // 4, zlib.crc32(cut)))
        return pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_rows(text_rows(docs), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# -- the plan --------------------------------------------------------------------

def patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Multisets of up to four present lengths that leave at most a hundredth of a sequence empty."""
    weight = np.cumsum(counts) / counts.sum()
    partners = np.unique(lengths[np.minimum(np.searchsorted(weight, (np.arange(PARTNERS) + 0.5) / PARTNERS), len(lengths) - 1)])
    found: set[tuple[int, ...]] = set()

    def close(head: tuple[int, ...]) -> None:
        room = capacity - sum(head)
        at = np.searchsorted(lengths, room, side="right") - 1
        whole = head if room <= capacity // 100 else (*head, int(lengths[at])) if at >= 0 and room > 0 else ()
        if whole and 0 <= capacity - sum(whole) <= capacity // 100:
            found.add(tuple(sorted(whole, reverse=True)))

    for a in lengths.tolist():
        close((a,))
        for b in partners.tolist():
            if a + b <= capacity:
                close((a, b))
                for c in partners[partners <= min(b, capacity - a - b)].tolist()[::4]:
                    close((a, b, c))
    return sorted(found)


def repeats(columns: list[tuple[int, ...]], wanted: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares: how often to use each pattern so that their lengths meet the histogram.

    Accelerated projected gradient; the matrix is only ever a list of (pattern, length) entries.
    """
    col = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    row = np.concatenate([np.array(c) for c in columns])
    x = y = np.zeros(len(columns))
    size = np.bincount(row, minlength=len(wanted))
    rate = 1.0 / max(1.0, float((np.bincount(col, weights=size[row])).max()))
    t = 1.0
    for _ in range(rounds):
        gap = np.bincount(row, weights=y[col], minlength=len(wanted)) - wanted
        nxt = np.maximum(0.0, y - rate * np.bincount(col, weights=gap[row], minlength=len(columns)))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = nxt + (t - 1) / t2 * (nxt - x), nxt, t2
    return x


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts of lengths; equal sequences are handled together."""
    bins: dict[int, list[list]] = {}  # free space -> [content, how many]
    spaces: list[int] = []

    def put(content: tuple[int, ...], free: int, n: int) -> None:
        if free not in bins:
            bins[free] = []
            insort(spaces, free)
        bins[free].append([content, n])

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                free = spaces[at]
                content, have = bins[free][-1]
                use = min(have, n)
                bins[free][-1][1] -= use
                if have == use:
                    bins[free].pop()
                    if not bins[free]:
                        del bins[free], spaces[at]
                put((*content, length), free - length, use)
                n -= use
            else:
                each = capacity // length
                if n >= each:
                    put((length,) * each, capacity - each * length, n // each)
                    n %= each
                else:
                    put((length,) * n, capacity - n * length, 1)
                    n = 0
    return [(content, n) for group in bins.values() for content, n in group]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted, for all pieces of the histogram."""
    lengths = np.array(sorted(histogram))
    wanted = np.zeros(capacity + 1)
    wanted[lengths] = [histogram[k] for k in lengths.tolist()]
    left = dict(histogram)
    made: list[tuple[tuple[int, ...], int]] = []
    columns = patterns(lengths, wanted[lengths], capacity)
    if columns:
        fitted = repeats(columns, wanted)
        for j in np.argsort(-fitted, kind="stable"):
            n = int(fitted[j])
            if n < 1:
                break
            for k in set(columns[j]):
                n = min(n, left[k] // columns[j].count(k))
            if n:
                made.append((columns[j], n))
                for k in columns[j]:
                    left[k] -= n
    made += best_fit({k: n for k, n in left.items() if n}, capacity)
    rows, used, sequence = [], dict.fromkeys(histogram, 0), 0
    for content, n in made:
        offset = 0
        for k in content:
            rows.append((k, used[k], sequence, offset))
            used[k] += n
            offset += k
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    cut = written(pieces(docs, capacity, path).withColumn("_row", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # `capacity` rows at most
    if not histogram:
        return cut.drop("_row").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    places = plan(histogram, capacity)
    # rank within the length: hot lengths are dealt to many tasks, each continues where the ones before it end
    salts = 1 + max(histogram.values()) // RANK_ROWS
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    sums = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = sums.select("length", "_salt", (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")))
    ranked = ranked.join(before, ["length", "_salt"]).withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
    key = places[:, 0] * (1 << 44) + places[:, 1]

    def place(f: pd.DataFrame) -> pd.DataFrame:
        rank = f["_rank"].to_numpy()
        at = np.searchsorted(key, f["length"].to_numpy() * (1 << 44) + rank, side="right") - 1
        return f.assign(sequence_id=places[at, 2] + rank - places[at, 1], offset=places[at, 3])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_rows(ranked.select(*columns, "_rank"), place, schema)
