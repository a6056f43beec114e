"""Reading of landed pages: elements as a tree, and JSON that scripts carry.

Both read one page in one pass, with a stack as deep as the page is.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable
from html.parser import HTMLParser

# Fixed values of the HTML standard: elements without content, elements whose start ends an
# open paragraph, elements that an end tag does not reach through, and for the elements
# whose end may be left out those whose start ends them.
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
WALLS = frozenset("table td th caption object template".split())
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "optgroup": frozenset(["optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "thead": frozenset(["tbody", "tfoot"]),
    "tbody": frozenset(["tbody", "tfoot"]),
    "a": frozenset(["a"]),
}
HOLDS = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "option": frozenset(["select", "datalist"]), "optgroup": frozenset(["select"])}
STARTS: dict[str, list[str]] = {}
for _ended, _starts in ENDED_BY.items():
    for _start in _starts:
        STARTS.setdefault(_start, []).append(_ended)
TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
SPACED = BLOCKS | TABLE | frozenset("li dt dd option".split())
UNSEEN = frozenset(["script", "style", "template"])
#: Elements that only mark text: where a page never ends one, its bare start tags say nothing.
INLINE = "abbr b bdi bdo big cite code dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split()
BARE = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*+)>")
BARE_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*+)>")
#: What stands in these is read as text, which the parser sees to.
OPAQUE = frozenset("script style title textarea iframe noembed noframes noscript xmp plaintext".split())


class Tree(HTMLParser):
    """Elements of interest in page order: where they stand, under which classes, with which text.

    End tags that may be left out are implied; other elements end with one that holds them.
    Where ``wants`` is given, only pieces that it takes before their end are kept and get a text.
    """

    def __init__(self, page: str, tags: frozenset[str], wants: Callable[[dict], bool] | None = None):
        super().__init__(convert_charrefs=True)
        self.tags, self.wants = tags, wants
        ended = {x.lower() for x in re.findall(r"</([a-zA-Z][a-zA-Z0-9]*)", page)}
        inert = [x for x in INLINE if x not in ended and x not in tags]
        # A tag that is repeated is compared, not searched for.
        self.inert = re.compile(rf"(?:(<(?:{'|'.join([*inert, *map(str.upper, inert)])})>)\1*+)++") if inert else None
        self.found: list[dict] = []
        self.meta: dict[str, str] = {}
        self.row, self.unseen = -1, 0
        self.open: list[tuple[str, dict | None, tuple[str, ...]]] = []
        self.count: dict[str, int] = defaultdict(int)
        self.said: list[str] = []
        self.at = self.begun = 0
        self.feed(page)
        self.begun = len(page) - len(self.rawdata)
        self.close()
        self.pop_to(0, len(page))
        for piece in self.found:
            piece["text"] = " ".join("".join(self.said[slice(*piece.pop("part"))]).split())

    def parse_starttag(self, i):
        # Tags without attributes need no search for these; runs that say nothing are one step.
        if self.inert and (m := self.inert.match(self.rawdata, i)):
            return m.end()
        if (m := BARE.match(self.rawdata, i)) and (tag := m[1].lower()) not in OPAQUE:
            self.handle_starttag(tag, ())
            return m.end()
        return super().parse_starttag(i)

    def parse_endtag(self, i):
        if self.cdata_elem is None and (m := BARE_END.match(self.rawdata, i)):
            self.handle_endtag(m[1].lower())
            return m.end()
        return super().parse_endtag(i)

    def updatepos(self, i, j):
        if i < j:
            self.at = self.begun + j
        return j

    def depth_of(self, tag: str, walls: frozenset[str]) -> int | None:
        """Where the innermost open element of that name stands, if no wall is in between."""
        if self.count[tag]:
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name == tag:
                    return i
                if name in walls:
                    return None
        return None

    def pop_to(self, depth: int, at: int) -> None:
        while len(self.open) > depth:
            name, piece, _ = self.open.pop()
            self.count[name] -= 1
            self.unseen -= name in UNSEEN
            if piece is not None:
                piece["end"], piece["part"] = at, (piece["part"], len(self.said))
            if name in SPACED:
                self.said.append(" ")

    def handle_starttag(self, tag, attrs):
        have = dict(attrs)
        at = self.at
        if tag in BLOCKS and (i := self.depth_of("p", WALLS)) is not None:
            self.pop_to(i, at)
        for ended in STARTS.get(tag, ()):
            walls = WALLS - {"td", "th"} if ended in TABLE else WALLS | HOLDS.get(ended, frozenset())
            if (i := self.depth_of(ended, walls - {ended})) is not None:
                self.pop_to(i, at)
        if tag == "meta" and have.get("content"):
            self.meta.setdefault(have.get("property") or have.get("name") or "", have["content"])
        if tag in EMPTY:
            self.said.append(" ")
            return
        if tag in SPACED:
            self.said.append(" ")
        self.row += tag == "tr"
        classes = self.open[-1][2] if self.open else ()
        if named := have.get("class"):
            classes += tuple(named.split())
        piece = None
        if tag in self.tags:
            piece = {"tag": tag, "row": self.row, "classes": classes, "id": have.get("id"), "href": have.get("href"), "start": at, "end": None, "part": len(self.said), "text": ""}
            if self.wants is None or self.wants(piece):
                piece["classes"] = list(classes)
                self.found.append(piece)
            else:
                piece = None
        self.open.append((tag, piece, classes))
        self.count[tag] += 1
        self.unseen += tag in UNSEEN

    def handle_endtag(self, tag):
        walls = frozenset() if tag in ("table", "template", "object") else WALLS - TABLE if tag in TABLE - {"table"} else WALLS
        if (i := self.depth_of(tag, walls - {tag})) is not None:
            self.pop_to(i, self.at + len(tag) + 3)

    def handle_data(self, data):
        if not self.unseen:
            self.said.append(data)


STRING = re.compile(r'"(?:[^"\\\n]++|\\.)*+', re.S)
#: A token other than a string; what breaks the brackets around it is one token up to the next that can matter.
TOKEN = re.compile(r'[{}\[\]:,]|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null|\s+|"|[^\s"{}\[\]:,]+', re.S)
SCRIPT = re.compile(r"<script\b[^>]*>(.*?)(?:</script\s*>|\Z)", re.S | re.I)
_NUMBER = re.compile(r"-?(?:0|[1-9])")


class _Frame:
    """An open bracket: what may come next (k key, c colon, v value, n a comma or the end, e the end or a first item; x broken)."""

    __slots__ = ("keys", "last", "object", "start", "state")

    def __init__(self, start: int, is_object: bool):
        self.start, self.object, self.state = start, is_object, "e"
        self.keys: set[str] = set()
        self.last = ""

    def value(self) -> None:
        self.state = "n" if self.state == "v" or self.state == "e" and not self.object else "x"


def objects_with(script: str, keys: frozenset[str]) -> list[str]:
    """JSON objects in a script that have all these members of their own, in order, as text.

    The script may be anything: an object counts if its brackets hold valid JSON, whatever
    stands around it.  Strings that themselves hold such objects are read as well.
    """
    found: list[tuple[int, str]] = []
    stack: list[_Frame] = []
    end, n, unended = 0, len(script), 0
    while end < n:
        at, end = end, TOKEN.match(script, end).end()
        if script[at] == '"' and at >= unended:
            stop = STRING.match(script, at).end()
            if script.startswith('"', stop):
                end = stop + 1
            else:
                # No quote up to there begins a string that ends, so none is followed again.
                unended = stop
        token = script[at:end]
        first, frame = token[0], stack[-1] if stack else None
        if token.isspace():
            continue
        if first in "{[":
            stack.append(_Frame(at, first == "{"))
        elif first in "}]":
            if not stack:
                continue
            # A bracket of the other kind breaks what it closes.
            frame = stack.pop()
            good = frame.object == (first == "}") and frame.state in "en"
            if good and frame.object and keys <= frame.keys:
                found.append((frame.start, script[frame.start : end]))
            if stack:
                if good:
                    stack[-1].value()
                else:
                    stack[-1].state = "x"
        elif first == '"' and len(token) > 1:
            if frame is not None and frame.object and frame.state in "ek":
                frame.last, frame.state = token, "c"
            elif frame is not None:
                frame.value()
            if '{\\"' in token:
                try:
                    inner = json.loads(token, strict=False)
                except ValueError:
                    continue
                found += [(at, x) for x in objects_with(inner, keys)]
        elif frame is None:
            continue
        elif token == ":":
            if frame.state == "c":
                try:
                    frame.keys.add(json.loads(frame.last))
                except ValueError:
                    frame.state = "x"
                    continue
                frame.state = "v"
            else:
                frame.state = "x"
        elif token == ",":
            frame.state = ("k" if frame.object else "v") if frame.state == "n" else "x"
        elif token in ("true", "false", "null") or _NUMBER.match(token):
            frame.value()
        else:
            frame.state = "x"
    found.sort(key=lambda x: x[0])
    return [text for _, text in found]


NAME = re.compile(r'"(?:[^"\\\n]++|\\.)*+')
VALUE = re.compile(r'"\s*+:\s*+("(?:[^"\\\n]++|\\.)*+"|-?[\d.]+|true|false|null)')


def loose_objects(script: str, keys: frozenset[str]) -> list[str]:
    """Members without brackets around them, as objects: one ends where a name comes again."""
    out, have = [], {}

    def done() -> None:
        if keys <= have.keys():
            out.append("{" + ",".join(f'"{k}":{v}' for k, v in have.items()) + "}")
        have.clear()

    at = script.find('"')
    while at >= 0:
        end = NAME.match(script, at).end()
        if m := VALUE.match(script, end):
            if (name := script[at + 1 : end]) in have:
                done()
            have[name] = m[1]
        # A string without an end holds none that ends.
        at = script.find('"', m.end() if m else at + 1 if script.startswith('"', end) else end)
    done()
    return out


def script_objects(page: str, keys: frozenset[str]) -> list[str]:
    """``objects_with`` over a page's scripts, or over all of it where it has none.

    Where none is found, escaped quotes are read as quotes, as some pages cut a string in
    pieces, and then members without brackets are taken.
    """
    parts = [m.group(1) for m in SCRIPT.finditer(page)] or [page]
    plain = [part.replace('\\"', '"') for part in parts]
    for read, texts in ((objects_with, parts), (objects_with, plain), (loose_objects, parts), (loose_objects, plain)):
        if out := [x for text in texts for x in read(text, keys)]:
            return out
    return []
