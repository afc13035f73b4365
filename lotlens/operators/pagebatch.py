"""Elements of many fetched pages at a time, as arrays: what `pagetree.Page` says of one page, without a Python step per tag.

Tags of a batch are numbered through; the place of a tag is its number. All pages move one tag ahead per step, each on
a stack of its own, which gives every element its parent and its end, closing tags left out included. The tests of
path expressions are then comparisons of places. Pages that cannot be cut at < and > alone (those signs in attributes,
open quotes, scripts or comments without end, very deep or very long ones) are marked in `odd` and left to `pagetree`.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np

from .pagetree import _ATTRIBUTE, _BLOCKS, _ENDED, _HEAD, _VOID, _WALLS

_KNOWN = sorted(
    _VOID | _BLOCKS | _WALLS | set(_ENDED) | set(
        "a abbr b button canvas caption center cite code dd del em figcaption font form h1 head html i iframe ins kbd label legend mark noscript object optgroup"
        " option picture q s samp script select small span strike strong style sub summary sup svg path textarea tfoot thead time title tt u var video".split()))
_NAME = 16  # bytes of a name that are read; longer ones make a page odd
#: So many pages of about one length are worth a walk together; fewer are odd.
_LANES = 24
_DEPTH = 256
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_QUOTE = np.zeros(256, dtype=bool)
_QUOTE[[34, 39]] = True
_STOP = _SPACE | _QUOTE
_STOP[[47, 62]] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[34, 39, 60, 62]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EACH = lambda byte: np.uint64(byte * 0x0101010101010101)
_STYLE, _SCRIPT = (np.frombuffer(x, dtype=np.uint8) for x in (b"style", b"script"))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SKIP, _OPEN, _ALONE, _CLOSE = 0, 1, 2, 3


def _keys(names: np.ndarray) -> np.ndarray:
    """A number for each row of 16 bytes."""
    two = np.ascontiguousarray(names).view(np.uint64)
    return two[:, 0] ^ (two[:, 1] * _MIX)


_KNOWN_KEYS = _keys(np.array([[*n.encode().ljust(_NAME, b"\0")] for n in _KNOWN], dtype=np.uint8))
_SHIFT = np.uint64(52)
_SLOTS = np.full(1 << 12, -1, dtype=np.int16)
for _seed in range(1, 1000, 2):
    _SPREAD = _MIX + np.uint64(_seed * 2)
    _at = (_KNOWN_KEYS * _SPREAD) >> _SHIFT
    if len(np.unique(_at)) == len(_at):
        break
_SLOTS[_at] = np.arange(len(_KNOWN))
_NUMBER = {n: i for i, n in enumerate(_KNOWN)}

# What a tag ends (need), and what an open element lets through from those it stands in (keep) and adds itself (own):
# one bit for paragraphs, one for each kind of element that another one ends.
_KINDS = [({"p"}, _WALLS | {"li"}, _BLOCKS)]
for _n in ("li", "dt", "option", "td", "tr"):
    _KINDS.append((_ENDED[_n][0], _ENDED[_n][1] | {"div"}, {m for m in _ENDED if _ENDED[m] == _ENDED[_n]}))
_MORE = 1 << 12  # numbers of names that are not known begin behind the known ones
_NEED, _KEEP, _OWN = (np.full(_MORE, x, dtype=np.uint8) for x in (0, 255, 0))
for _bit, (_ended, _through, _by) in enumerate(_KINDS):
    for _n, _i in _NUMBER.items():
        if _n in _by:
            _NEED[_i] |= 1 << _bit
        if _n in _ended:
            _OWN[_i] |= 1 << _bit
        elif _n in _through:
            _KEEP[_i] &= 255 - (1 << _bit)
# name, own, keep and need in one number; a closing tag has no need
_CODE = np.arange(_MORE, dtype=np.int64) | (_OWN.astype(np.int64) << 16) | (_KEEP.astype(np.int64) << 32) | (_NEED.astype(np.int64) << 40)
_MASK = np.array([(1 << 40) - 1, (1 << 48) - 1, (1 << 48) - 1, (1 << 40) - 1], dtype=np.int64)
_IS_VOID = np.zeros(_MORE, dtype=bool)
_IS_VOID[[_NUMBER[n] for n in _VOID]] = True
_IS_WALL = np.zeros(_MORE, dtype=bool)
_IS_WALL[[_NUMBER[n] for n in _WALLS]] = True
_RAW_ID = [_NUMBER["script"], _NUMBER["style"]]
_RAW_END = {"script": re.compile(rb"</script", re.I), "style": re.compile(rb"</style", re.I)}


@lru_cache(20_000)
def _attributes(rest: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for k, a, b, c in _ATTRIBUTE.findall(rest.decode()):
        found.setdefault(k.lower(), html.unescape(a or b or c))
    return found


def _outside(at: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which sorted positions lie in none of the stretches (sorted, apart)."""
    turn = np.zeros(len(at) + 1, dtype=np.int32)
    np.add.at(turn, np.searchsorted(at, first), 1)
    np.subtract.at(turn, np.searchsorted(at, stop), 1)
    return np.cumsum(turn[:-1]) == 0


def _spots(data: bytes, word: bytes) -> np.ndarray:
    """Where a word begins."""
    if len(word) == 1:
        return np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == word[0])
    out, at = [], data.find(word)
    while at >= 0:
        out.append(at)
        at = data.find(word, at + 1)
    return np.array(out, dtype=np.int64)


def _number(key: np.ndarray) -> np.ndarray:
    number = _SLOTS[((key * _SPREAD) >> _SHIFT).astype(np.int64)].astype(np.int32)
    number[_KNOWN_KEYS[number] != key] = -1
    return number


def _short_names(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the known names that eight bytes begin with, below 0 where there is none, and the lengths.

    All eight bytes at once: a name ends at the first byte that is neither letter nor digit.
    """
    low = words | _EACH(0x20)
    no_digit = (low ^ _EACH(0x30)) + _EACH(0x76)
    ends = no_digit & (~low << np.uint64(1)) & _EACH(0x80)
    mask = ((ends & (~ends + np.uint64(1))) >> np.uint64(7)) - np.uint64(1)
    number = _number(low & mask)
    number[ends == 0] = -1
    return number, (np.bitwise_count(mask) >> 3).astype(np.int64)


class Pages:
    """Tags of the pages data[bounds[i]:bounds[i + 1]] that are not `odd`."""

    def __init__(self, data: bytes, bounds: np.ndarray):
        self.raw, self.bounds = data, bounds
        self.odd = np.zeros(len(bounds) - 1, dtype=bool)
        self.bytes = np.frombuffer(data + b"\0" * (40 - len(data) % 8), dtype=np.uint8)
        self._cut()
        self._nest()
        self._places: dict[str, np.ndarray] = {}
        self._found: dict[str, np.ndarray] = {}
        self._stream: tuple | None = None

    # -- tags ------------------------------------------------------------------

    def _cut(self) -> None:
        raw, b, bounds, odd = self.raw, self.bytes, self.bounds, self.odd
        signs = np.flatnonzero(_SIGN[b])
        sign = b[signs]
        lt, gt = signs[sign == 60], signs[sign == 62]
        after = b[lt + 1]
        then = b[lt + 2] | 32
        maybe = lt[((after == 33) & (then == 45)) | (((after | 32) == 115) & ((then == 99) | (then == 116)))]
        first, stop = [], []  # where < and > are no tags: the insides of comments, scripts and styles
        over = 0
        pages = (np.searchsorted(bounds, maybe, side="right") - 1).tolist()
        comments, scripts = [], []
        for at, page in zip(maybe.tolist(), pages):
            if at < over or odd[page]:
                continue
            end = int(bounds[page + 1])
            if raw.startswith(b"<!--", at):
                close = raw.find(b"-->", at + 4, end)
                if close < 0:
                    odd[page] = True
                    continue
                comments.append(at)
                first.append(at + 1)
                stop.append(close + 2)
                over = close + 3
            elif raw[at + 1:at + 6].lower() in (b"scrip", b"style"):
                name = "script" if raw[at + 1:at + 7].lower() == b"script" else "style" if raw[at + 1:at + 6].lower() == b"style" else ""
                if not name:
                    continue
                beyond = raw[at + 1 + len(name):at + 2 + len(name)]
                gone = raw.find(b">", at, end)
                close = _RAW_END[name].search(raw, gone + 1, end) if gone >= 0 and beyond in (b">", b" ", b"\n", b"\t", b"\r") else None
                if close is None:
                    odd[page] = True
                    continue
                scripts.append(at)
                first.append(gone + 1)
                stop.append(close.start())
                over = close.start()
        if first:
            first, stop = np.array(first), np.array(stop)
            lt, gt = lt[_outside(lt, first, stop)], gt[_outside(gt, first, stop)]
        count = np.diff(np.searchsorted(lt, bounds))
        page = np.repeat(np.arange(len(odd)), count)
        if len(lt) != len(gt) or (lt > gt).any() or (gt[:-1] > lt[1:]).any():  # else every tag has its own
            gt = np.append(gt, len(raw))[np.searchsorted(gt, lt)]
        limit = np.append(lt[1:], len(raw) + 1)
        last = np.cumsum(count)[count > 0] - 1
        limit[last] = bounds[1:][count > 0]
        closing = b[lt + 1] == 47
        start = lt + 1 + closing
        skip = (b[lt + 1] == 33) | (b[lt + 1] == 63)
        wrong = gt >= limit
        number, length = _short_names(self._eight(start))
        stay_name = start + length
        number[~_STOP[b[stay_name]] | _QUOTE[b[stay_name]]] = -1
        rest = np.flatnonzero((number < 0) & ~skip)
        if len(rest):
            wrong[rest] |= self._long_names(rest, start, number, stay_name)
        number[skip] = -1
        # quotes must be closed where the tag ends
        raws = ((number == _RAW_ID[0]) | (number == _RAW_ID[1])) & ~closing
        whole = np.zeros(len(lt), dtype=bool)  # comments, scripts and styles with an end
        whole[np.searchsorted(lt, np.array(comments + scripts, dtype=np.int64))] = True
        wrong |= (raws | (skip & (b[lt + 2] == 45) & (b[lt + 3] == 45) & (b[lt + 1] == 33))) & ~whole
        long = np.flatnonzero(~skip & ~raws & ~wrong & (gt > stay_name))
        two, one = np.cumsum(sign == 34), np.cumsum(sign == 39)
        begin = np.searchsorted(signs, lt[long])
        until = np.minimum(np.searchsorted(signs, gt[long]), len(signs) - 1)
        n2, n1 = two[until] - two[begin], one[until] - one[begin]
        wrong[long[((n1 == 0) & (n2 % 2 == 1)) | ((n2 == 0) & (n1 % 2 == 1))]] = True
        for i in long[(n1 > 0) & (n2 > 0)].tolist():
            if _HEAD.fullmatch(raw[lt[i] + 1:gt[i]].decode()) is None:
                wrong[i] = True
        long = long[~closing[long]]
        long = long[b[gt[long] - 1] == 47]
        before = b[gt[long] - 2]
        alone = np.zeros(len(lt), dtype=bool)
        alone[long] = (stay_name[long] == gt[long] - 1) | _SPACE[before] | _QUOTE[before]
        wrong[long[before > 127]] = True
        odd[page[wrong]] = True
        width = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)  # pages of about one length move together
        odd |= (np.bincount(width[~odd], minlength=64) < _LANES)[width] & (count > 0)
        self.width = width
        kept = ~odd[page]
        self.page = page[kept]
        self.count = np.where(odd, 0, count)
        self.lt, self.gt, self.head, self.name = (x if kept.all() else x[kept] for x in (lt, gt, stay_name, number))
        limit = limit[kept]
        void = ~closing & (alone | (_IS_VOID[number] & ~skip))
        kind = np.where(skip, _SKIP, np.where(closing, _CLOSE, np.where(void, _ALONE, _OPEN)))[kept]
        self.kind = kind.astype(np.int8)
        self.code = _CODE[self.name] & _MASK.take(kind) | (kind << 48)
        # the text behind a tag, none behind that of a script
        self.text_from, self.text_to = self.gt + 1, np.where(raws[kept], self.gt + 1, limit)

    def _eight(self, at: np.ndarray) -> np.ndarray:
        """The eight bytes from each place on, as one number."""
        words = self.bytes.view("<u8")
        k, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return (words.take(k) >> shift) | ((words.take(k + 1) << np.uint64(1)) << (np.uint64(63) - shift))

    def _long_names(self, rest: np.ndarray, start: np.ndarray, number: np.ndarray, stay_name: np.ndarray) -> np.ndarray:
        """Numbers of names that are long or not known; which of them are none."""
        names = _LOWER[self.bytes[start[rest][:, None] + np.arange(_NAME)]]
        ends = _STOP[names]
        length = ends.argmax(axis=1)
        names *= np.arange(_NAME) < length[:, None]
        stay_name[rest] = start[rest] + length
        wrong = (names[:, 0] < 97) | (names[:, 0] > 122) | ~ends.any(axis=1) | (names > 127).any(axis=1) | _QUOTE[self.bytes[stay_name[rest]]]
        wrong |= (names[:, :5] == _STYLE).all(axis=1) | (names[:, :6] == _SCRIPT).all(axis=1)  # names that only begin so
        key = _keys(names)
        known = _number(key)
        new = known < 0
        kinds, which = np.unique(key[new], return_inverse=True)
        known[new] = np.minimum(len(_KNOWN) + which, _MORE - 1)
        number[rest] = known
        return wrong | (len(kinds) > _MORE - len(_KNOWN))

    # -- nesting ---------------------------------------------------------------

    def _nest(self) -> None:
        n, kind = len(self.lt), self.kind
        first = np.cumsum(self.count) - self.count
        opens = kind == _OPEN
        self.end = np.where(opens, np.repeat(first + self.count, self.count), np.arange(n))
        self.parent = np.empty(n, dtype=np.int64)
        for width in np.unique(self.width[self.count > 0]).tolist():
            pages = np.flatnonzero((self.width == width) & (self.count > 0))
            pages = pages[np.argsort(-self.count[pages], kind="stable")]
            self._walk(pages, first[pages], self.count[pages])
        self.above = np.where(opens, np.arange(n), self.parent)  # the element that holds the text behind a tag
        self.element = opens | (kind == _ALONE)
        if self.odd.any():
            self.element &= ~self.odd[self.page]

    def _walk(self, pages: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        """Parents and ends in pages of about one length, the longest first: all of them one tag further per step.

        An entry of a page's stack is the tag's number in its page, what the element lets end (`reach`), and its name.
        """
        lanes, steps = len(pages), int(count[0])
        place = np.minimum(first + np.arange(steps)[:, None], len(self.kind) - 1)
        code = self.code.take(place)
        kind = code >> 48
        shut, opens = kind == _CLOSE, (kind == _OPEN) * lanes
        need, keep = (code >> 40 & 0xFF) << 16, (code >> 32 & 0xFF) << 16
        entry = (code & 0xFFFFFF) | (np.arange(steps, dtype=np.int64)[:, None] << 32)
        holder, ended = np.empty((steps, lanes), dtype=np.int64), np.full((steps, lanes), -1, dtype=np.int64)
        stack = np.zeros((_DEPTH, lanes), dtype=np.int64)
        stack[0] = (-1 << 32) | 0xFFFF
        flat = stack.reshape(-1)
        spot = np.arange(lanes)  # of the top entry
        live = lanes
        deep: set[int] = set()
        for t in range(steps):
            while count[live - 1] <= t:
                live -= 1
            at, now = spot[:live], entry[t, :live]
            top = flat.take(at)
            close = shut[t, :live]
            same = close & (((top ^ now) & 0xFFFF) == 0)
            other = (close ^ same) | ((top & need[t, :live]) != 0)
            np.copyto(ended[t, :live], top >> 32, where=same)
            at -= same * lanes
            if other.any():
                lone = np.flatnonzero(other)
                # a closing tag of the element around the open one, which had none of its own
                up, tag = flat.take(at[lone] - lanes, mode="clip"), now[lone] & 0xFFFF
                both = close[lone] & ((up & 0xFFFF) == tag) & (at[lone] >= 2 * lanes) & (~_IS_WALL[top[lone] & 0xFFF] | _IS_WALL[tag])
                two = lone[both]
                self.end[first[two] + (top[two] >> 32)] = first[two] + t
                self.end[first[two] + (up[both] >> 32)] = first[two] + t
                at[two] -= 2 * lanes
                for lane in lone[~both].tolist():
                    here = int(at[lane]) // lanes
                    open_ = stack[:here + 1, lane].tolist()
                    down = self._down([e & 0xFFFF for e in open_], int(now[lane]) & 0xFFFF, bool(close[lane]))
                    for e in open_[down:]:
                        self.end[first[lane] + (e >> 32)] = first[lane] + t
                    at[lane] = lane + min(down - 1, here) * lanes
            top = flat.take(at)
            np.right_shift(top, 32, out=holder[t, :live])
            flat[at + lanes] = now | (top & keep[t, :live])
            at += opens[t, :live]
            if t >= _DEPTH - 2:
                for lane in np.flatnonzero(at >= (_DEPTH - 2) * lanes).tolist():  # too deep: its places are never read
                    deep.add(int(pages[lane]))
                    at[lane] = lane
        there = np.arange(steps)[:, None] < count
        roots = len(self.lt) + pages  # a page's own root
        self.parent[place[there]] = np.where(holder < 0, roots, first + holder)[there]
        gone = there & (ended >= 0)
        self.end[(first + ended)[gone]] = place[gone]
        if deep:
            self.odd[[*deep]] = True

    @staticmethod
    def _down(open_: list[int], tag: int, closes: bool) -> int:
        """From which open element on all end at a tag; beyond the last one if none does."""
        known, here = len(_KNOWN), len(open_) - 1
        name = _KNOWN[tag] if tag < known else ""
        word = lambda k: _KNOWN[open_[k]] if open_[k] < known else ""
        if closes:
            for k in range(here, 0, -1):
                if open_[k] == tag:
                    return k
                if word(k) in _WALLS and name not in _WALLS and name not in ("html", "form"):
                    break
            return here + 1
        if name in _BLOCKS:
            for k in range(here, 0, -1):
                if word(k) == "p":
                    return k
                if word(k) in _WALLS or word(k) == "li":
                    break
        down = here + 1
        if name in _ENDED:
            ends, walls = _ENDED[name]
            for k in range(here, 0, -1):
                if word(k) in ends:
                    down = k
                elif word(k) in walls or word(k) == "div":
                    break
        return down

    # -- tests -----------------------------------------------------------------

    def all(self, tag: str) -> np.ndarray:
        """Elements of a name, in order."""
        if tag not in self._places:
            self._places[tag] = np.flatnonzero((self.name == _NUMBER[tag]) & self.element)
        return self._places[tag]

    def within(self, roots: np.ndarray, tag: str) -> np.ndarray:
        """Elements below any of the roots (sorted), each once."""
        places = self.all(tag)
        if not len(roots):
            return places[:0]
        far = np.maximum.accumulate(self.end[roots])
        k = np.searchsorted(roots, places) - 1
        return places[(k >= 0) & (places < far[k])]

    def children(self, of: np.ndarray, tag: str) -> np.ndarray:
        """Children of the elements, those of one element after the other."""
        places = self.all(tag)
        wanted = np.zeros(len(self.lt) + len(self.odd), dtype=bool)
        wanted[of] = True
        found = places[wanted[self.parent[places]]]
        return found[np.argsort(self.parent[found], kind="stable")]

    def after(self, of: np.ndarray, tag: str) -> np.ndarray:
        """Siblings that follow any of the elements (sorted), each once."""
        places = self.all(tag)
        first = np.full(len(self.lt) + len(self.odd), len(self.lt) + 1)
        first[self.parent[of][::-1]] = of[::-1]
        return places[places > first[self.parent[places]]]

    def next_after(self, of: np.ndarray, tag: str) -> np.ndarray:
        """The first sibling that follows each of the elements, each once."""
        places, wide = self.all(tag), len(self.lt) + 1
        keys = np.sort(self.parent[places] * wide + places)
        k = np.searchsorted(keys, self.parent[of] * wide + of)
        there = k < len(keys)
        got = keys[k[there]]
        return np.unique((got % wide)[got // wide == self.parent[of][there]])

    def attribute(self, i: int, name: str) -> str | None:
        rest = self.raw[self.head[i]:self.gt[i]]
        return (_attributes(rest) if len(rest) < 200 else _attributes.__wrapped__(rest)).get(name)

    def _at(self, part: str) -> np.ndarray:
        """Where the pages hold a text, at its first byte."""
        if part not in self._found:
            word = part.encode()
            self._found[part] = _spots(self.raw, word)
        return self._found[part]

    def has(self, found: np.ndarray, name: str, part: str) -> np.ndarray:
        """Those of the elements whose attribute holds a text."""
        lo, hi = self.head[found], self.gt[found]
        may = np.zeros(len(found), dtype=bool)
        for word in (part, "&"):
            spots = np.append(self._at(word), 1 << 62)
            may |= spots[np.searchsorted(spots, lo)] + len(word.encode()) <= hi
        some = found[may]
        return some[[part in (self.attribute(i, name) or "") for i in some.tolist()]] if len(some) else some

    # -- texts -----------------------------------------------------------------

    def _texts(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All text in one, where that behind each tag begins there, and its ampersands."""
        if self._stream is None:
            turn = np.zeros(len(self.bytes) + 1, dtype=np.int8)
            turn[self.text_from] = 1
            turn[self.text_to] -= 1
            stream = self.bytes[np.cumsum(turn[:-1], dtype=np.int8).view(bool)]
            begin = np.concatenate([[0], np.cumsum(self.text_to - self.text_from)])
            self._stream = (stream.tobytes(), begin, np.flatnonzero(stream == 38))
        return self._stream

    def text(self, i: int) -> str:
        """All text inside."""
        stream, begin, _ = self._texts()
        found = stream[begin[i]:begin[self.end[i]]].decode()
        return html.unescape(found) if "&" in found else found

    def holding(self, found: np.ndarray, word: str) -> np.ndarray:
        """Those of the elements with a word in their text."""
        stream, begin, amp = self._texts()
        lo, hi = begin[found], begin[self.end[found]]
        far = 1 << 62
        coded = word.encode()
        key = "text of " + word
        if key not in self._found:
            self._found[key] = np.append(_spots(stream, coded), far)
        spots = self._found[key]
        hit = spots[np.searchsorted(spots, lo)] + len(coded) <= hi
        amp = np.append(amp, far)
        for k in np.flatnonzero(amp[np.searchsorted(amp, lo)] < hi).tolist():
            hit[k] = word in self.text(int(found[k]))
        return found[hit]

    def own_texts(self, of: np.ndarray, first: bool = False) -> list[tuple[int, int, str]]:
        """(page, element, text) for each stretch of text directly inside the elements, one element after the other; or
        the `first` of each page."""
        wanted = np.zeros(len(self.lt) + len(self.odd), dtype=bool)
        wanted[of] = True
        texts = np.flatnonzero(wanted[self.above] & (self.text_to > self.text_from))
        holder = self.above[texts]
        order = np.argsort(holder, kind="stable")
        texts, holder = texts[order], holder[order]
        run = np.cumsum(self.element)[texts]  # a new element parts two texts, comments and lone closing tags do not
        new = np.ones(len(texts), dtype=bool)
        new[1:] = (holder[1:] != holder[:-1]) | (run[1:] != run[:-1])
        if first:
            page = self.page[texts]
            start = np.ones(len(texts), dtype=bool)
            start[1:] = page[1:] != page[:-1]
            run = np.cumsum(new)
            keep = run == run[np.maximum.accumulate(np.where(start, np.arange(len(texts)), 0))] if len(texts) else start
            texts, holder, new = texts[keep], holder[keep], new[keep]
        out: list[tuple[int, int, str]] = []
        raw, at = self.raw, ""
        parts = zip(self.page[texts].tolist(), holder.tolist(), self.text_from[texts].tolist(), self.text_to[texts].tolist(), new.tolist())
        for page, element, a, b, begins in parts:
            words = raw[a:b].decode()
            if begins:
                out.append((page, element, words))
            else:
                out[-1] = (page, element, out[-1][2] + words)
        return [(p, e, html.unescape(t) if "&" in t else t) for p, e, t in out]

    def firsts(self, found: np.ndarray, n: int = 1) -> np.ndarray:
        """The first n of each page."""
        page = self.page[found]
        begin = np.searchsorted(page, page)
        return found[np.arange(len(found)) - begin < n]
