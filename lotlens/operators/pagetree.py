"""Elements of one fetched page with their nesting: the small helper behind listing extraction.

A page is cut into tags and texts once, at its < where no attribute holds < or >, else by one pattern. A stack of open elements gives every element its parent and its end, so a block
stops at its own closing tag, whatever stands inside it. The tests are those of path expressions: descendants,
children, following siblings, the text of an element.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterable

# a text; an element whose inside is no markup; a tag; comments and declarations; a < that begins no tag
_TOKEN = re.compile(
    r"""([^<]+)|<((?i:script|style))\b([^>]*)>(?s:.*?)(?=</(?i:\2)|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|(?s:<!--.*?(?:-->|\Z))|<[!?][^>]*>|(<)(?![A-Za-z/!?])""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_RAW = re.compile(r"((?i:script|style))\b([^>]*)")
_EMPTY = re.compile(r"""(?:^|["'\s])/$""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: An element on the left ends where one on the right begins, unless an element of the third column is open in between.
_ENDED = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}),
}
#: A closing tag of anything else does not reach out of these.
_WALLS = frozenset("div section article main table td th ul ol body".split())


_TAG = re.compile("<([^<>]+)>")
_HEAD = re.compile(r"""(/?)([A-Za-z][^\s/>"']*)((?:[^>"']|"[^"]*"|'[^']*')*)""")
#: What the inside of a tag says, for tags met before: (closing, name, attributes, ends others, stays open).
_HEADS: dict[str, tuple[bool, str, str, bool, bool]] = {}
_HEADS_KEPT = 20_000


def _head(inside: str) -> tuple[bool, str, str, bool, bool] | None:
    """Of a plain tag; None where quotes are open or the page holds something else."""
    m = _HEAD.fullmatch(inside)
    if m is None or (m[3] and m[3][0] in "\"'"):
        return None
    name = m[2].lower()
    if not m[1] and name.startswith(("script", "style")):
        return None
    known = (m[1] != "", name, m[3], name in _BLOCKS or name in _ENDED, name not in _VOID and not (m[3].endswith("/") and _EMPTY.search(m[3])))
    if len(inside) < 200:
        if len(_HEADS) >= _HEADS_KEPT:
            _HEADS.clear()
        _HEADS[inside] = known
    return known


class Page:
    """Elements and texts in page order: `tag` (empty for a text), `parent`, `end` (the place after the last descendant), `value`."""

    def __init__(self, text: str):
        self._clear()
        if not self._quick(text):
            self._clear()
            self._whole(text)

    def _clear(self) -> None:
        self.tag, self.parent, self.end, self.value = [""], [-1], [0], [""]
        self._of: dict[str, list[int]] = {}  # the places of each tag
        self._attributes: dict[int, dict[str, str]] = {}
        self._texts: dict[int, str] = {}

    def _quick(self, text: str) -> bool:
        """The page cut at its plain tags; False where that is no way to cut it: < or > in attributes or alone, open ends."""
        tag, parent, end, value, of = self.tag, self.parent, self.end, self.value, self._of
        heads = _HEADS
        open_ = [0]
        top, at = 0, 1  # the element open now, the place of the next one
        parts = iter(_TAG.split(text))  # texts and insides of tags in turn
        for words in parts:
            if words:
                while "<" in words:  # of a comment that holds tags
                    start = words.find("<!--")
                    if start < 0 or "<" in words[:start]:
                        return False
                    if start:
                        tag.append("")
                        value.append(words[:start])
                        parent.append(top)
                        at += 1
                        end.append(at)
                    words = words[start + 4:]
                    while (stop := words.find("-->")) < 0:
                        inside = next(parts, None)
                        if inside is None:
                            words = ""
                            break
                        if inside.endswith("--"):
                            words = next(parts)
                            break
                        words = next(parts)
                    else:
                        words = words[stop + 3:]
                if words:
                    tag.append("")
                    value.append(words)
                    parent.append(top)
                    at += 1
                    end.append(at)
            inside = next(parts, None)
            if inside is None:
                break
            known = heads.get(inside) or _head(inside)
            if known is None:
                if inside.startswith("!--"):
                    if len(inside) < 5 or not inside.endswith("--"):
                        return False
                    continue
                if inside[:1] in ("!", "?"):
                    continue
                raw = _RAW.match(inside)
                if raw is None:
                    return False
                name = raw[1].lower()
                tag.append(name)
                value.append(raw[2])
                of.setdefault(name, []).append(at)
                parent.append(top)
                open_.append(at)
                at += 1
                end.append(at)
                over = "/" + name
                for words in parts:
                    inside = next(parts, None)
                    if "</" in words or inside is None:
                        return False
                    if inside[:len(over)].lower() == over:
                        break
                known = _head(inside)
                if known is None:
                    return False
            closing, name, rest, ends, stays = known
            if closing:
                top = open_[-1]
                if tag[top] == name:
                    end[top] = at
                    open_.pop()
                else:
                    self._close(name, open_)
                top = open_[-1]
                continue
            if ends:
                self._implied(name, open_)
                top = open_[-1]
            tag.append(name)
            value.append(rest)
            if name in of:
                of[name].append(at)
            else:
                of[name] = [at]
            parent.append(top)
            if stays:
                open_.append(at)
                top = at
            at += 1
            end.append(at)
        while open_:
            end[open_.pop()] = at
        return True

    def _whole(self, text: str) -> None:
        tag, parent, end, value = self.tag, self.parent, self.end, self.value
        open_ = [0]
        at = 1
        for words, raw, raw_rest, closing, name, rest, lone in _TOKEN.findall(text):
            if words or lone:
                tag.append("")
                value.append(words or lone)
            elif closing:
                name = name.lower()
                if tag[open_[-1]] == name:
                    end[open_.pop()] = at
                else:
                    self._close(name, open_)
                continue
            elif name or raw:
                name = (name or raw).lower()
                if name in _BLOCKS or name in _ENDED:
                    self._implied(name, open_)
                tag.append(name)
                value.append(rest or raw_rest)
                self._of.setdefault(name, []).append(at)
            else:
                continue
            parent.append(open_[-1])
            end.append(at + 1)
            if name and name not in _VOID and not (rest.endswith("/") and _EMPTY.search(rest)):
                open_.append(at)
            at += 1
        while open_:
            end[open_.pop()] = at

    def _pop(self, open_: list[int], down_to: int) -> None:
        while len(open_) > down_to:
            self.end[open_.pop()] = len(self.tag)

    def _implied(self, name: str, open_: list[int]) -> None:
        """End what cannot hold the element that begins."""
        if name in _BLOCKS and self.tag[open_[-1]] != "div":
            for k in range(len(open_) - 1, 0, -1):
                if self.tag[open_[k]] == "p":
                    return self._pop(open_, k)
                if self.tag[open_[k]] in _WALLS or self.tag[open_[k]] == "li":
                    break
        if name in _ENDED:
            ends, walls = _ENDED[name]
            for k in range(len(open_) - 1, 0, -1):
                if self.tag[open_[k]] in ends:
                    self._pop(open_, k)
                elif self.tag[open_[k]] in walls or self.tag[open_[k]] == "div":
                    break

    def _close(self, name: str, open_: list[int]) -> None:
        for k in range(len(open_) - 1, 0, -1):
            tag = self.tag[open_[k]]
            if tag == name:
                return self._pop(open_, k)
            if tag in _WALLS and name not in _WALLS and name not in ("html", "form"):
                return None

    # -- tests ---------------------------------------------------------------

    def attribute(self, i: int, name: str) -> str | None:
        if i not in self._attributes:
            found: dict[str, str] = {}
            for k, a, b, c in _ATTRIBUTE.findall(self.value[i]):
                found.setdefault(k.lower(), html.unescape(a or b or c))
            self._attributes[i] = found
        return self._attributes[i].get(name)

    def has(self, i: int, name: str, part: str) -> bool:
        raw = self.value[i]
        return (part in raw or "&" in raw) and part in (self.attribute(i, name) or "")

    def within(self, roots: Iterable[int], tag: str) -> list[int]:
        """Elements below any of the roots, each once, in page order."""
        out: list[int] = []
        done = 0
        places = self._of.get(tag, [])
        for r in sorted(roots):
            if self.end[r] > done:
                out += places[bisect_left(places, max(r + 1, done)):bisect_left(places, self.end[r])]
                done = self.end[r]
        return out

    def children(self, i: int, tag: str) -> list[int]:
        places = self._of.get(tag)
        if places is None:
            return []
        parent = self.parent
        return [j for j in places[bisect_left(places, i + 1):bisect_left(places, self.end[i])] if parent[j] == i]

    def after(self, i: int, tag: str) -> list[int]:
        """Following siblings."""
        places = self._of.get(tag)
        if places is None:
            return []
        parent = self.parent
        above = parent[i]
        return [j for j in places[bisect_left(places, self.end[i]):bisect_left(places, self.end[above])] if parent[j] == above]

    def text(self, i: int) -> str:
        """All text inside."""
        if i not in self._texts:
            raw = "".join([self.value[j] for j in range(i + 1, self.end[i]) if not self.tag[j]])
            self._texts[i] = html.unescape(raw) if "&" in raw else raw
        return self._texts[i]

    def own_texts(self, i: int) -> list[str]:
        """The texts directly inside: one for each stretch between elements."""
        out: list[str] = []
        last = -2
        tag, end, j, stop = self.tag, self.end, i + 1, self.end[i]
        while j < stop:
            if tag[j]:
                j = end[j]
                continue
            if j == last + 1:  # a comment or a lone < parted it
                out[-1] += self.value[j]
            else:
                out.append(self.value[j])
            last = j
            j += 1
        return [html.unescape(t) if "&" in t else t for t in out]
