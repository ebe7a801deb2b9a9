"""Small lexers that can start in the middle of a file.

A file is cut into ranges at a byte that each format is full of (a closing brace, a
closing bracket of a tag, a line feed). What a range starts in is not known: text or a
string, a comment, a quoted field. So a range is first walked once for every such
beginning that its bytes allow (most fail at the first token), and gives a summary: how
it ends, which containers it closes that it did not open, and which it leaves open.
Summaries of a file, put together in order, give every range its true state; with it a
range is walked again and its records are cut exactly, whatever they contain.

Each lexer has
* ``SEPARATOR``, the byte that ranges end with, and ``START``, the state of a file's start,
* ``summary(data, first)``, with an entry for each possible beginning,
* ``after(state, summary)``, the state behind a range that starts in ``state``,
* ``finish(state)``, which fails unless a file may end there,
* ``cut(data, state, more)``, the (name, text) of each record that starts in the data.
  ``more()`` gives bytes beyond the data, to end a record that goes on there.

States are JSON values. A ``ValueError`` says what is wrong with a document.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Callable, Iterator, Sequence

More = Callable[[], bytes]


class _Ends(Exception):
    """The data ends inside a token."""


# ---- JSON

_WS = rb"[ \t\n\r]*+"
_CHARS = rb'(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+'
_STRING = rb'"' + _CHARS + rb'"'
_SCALAR = rb"(?:%b|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?(?![0-9.eE])|true|false|null|NaN|-?Infinity)" % _STRING
_PAIR = _STRING + _WS + rb":" + _WS + _SCALAR + _WS
_FLAT = rb"\{" + _WS + rb"(?:%b(?:,%b%b)*+)?+\}" % (_PAIR, _WS, _PAIR)
_TOKEN = re.compile(_WS + rb"(?:(%b)|(%b)|(%b)|([{}\[\]:,])|(\Z))" % (_FLAT, _STRING, _SCALAR))
_MORE_FLAT = re.compile(rb"(?:%b,%b%b)*+" % (_WS, _WS, _FLAT))
_NEXT_FLAT = re.compile(rb"%b,%b(%b)" % (_WS, _WS, _FLAT))
_OPEN_STRING = re.compile(_WS + rb'"' + _CHARS + rb"\\?\Z")
_STRING_END = re.compile(_CHARS + rb'"')
_STRING_GOES_ON = re.compile(_CHARS + rb"\\?\Z")

_FLAT_TOKEN, _STRING_TOKEN, _SCALAR_TOKEN, _MARK_TOKEN, _END_TOKEN = 1, 2, 3, 4, 5


class _Frame:
    """An open container: its kind ("{", "[" or unknown), whether its last key is the
    wanted one (None: no key seen), and how many arrays stood there."""

    def __init__(self, kind: str | None, wanted: bool | None = None) -> None:
        self.kind, self.wanted, self.arrays, self.touched = kind, wanted, 0, False

    def told(self) -> list:
        return [self.kind, self.wanted, self.arrays, self.touched]


class _JsonWalk:
    """Tokens in their order, checked against the grammar of JSON.

    Without ``frames`` the containers around the data are unknown, one at a time.
    """

    def __init__(self, lexer: JsonLexer, data: bytes, lex: str, frames: list[_Frame] | None) -> None:
        self.key, self.data, self.at = lexer.key, data, 0
        self.known = frames is not None
        self.frames = frames if frames is not None else [_Frame(None)]
        self.closed: list[list] = []
        self.lex = lex
        # What may come: start, key, key or end, colon, value, item, item or end, after,
        # either (key or item of an unknown container), told (what the string was).
        self.expect = {"start": "start", "text": "after", "end": "end"}.get(lex, "after")
        self.last = b""
        self.top = _Frame("{")  # the top object, once it has ended
        # With a list here the elements of the wanted array are put there as (from, to).
        self.found: list[tuple[int, int]] | None = None
        self.record: int | None = None  # where the open element began; -1: before the data
        self.open_string = False  # a string began in the data and goes on beyond

    def bad(self, what: str) -> ValueError:
        shown = self.data[self.at : self.at + 60].decode("utf-8", "replace")
        return ValueError(f"broken JSON, {what}: {shown!r}")

    def string_end(self) -> bool:
        """Leaves the string that the data starts in; False if all of it is inside."""
        end = _STRING_END.match(self.data)
        if end is None:
            if _STRING_GOES_ON.match(self.data):
                return False
            raise self.bad("a string")
        self.at = end.end()
        self.expect = "colon" if self.lex == "key" else "after"
        if self.lex == "key":
            self.frames[-1].wanted = False  # the wanted key holds no separator
        self.lex = "text"
        return True

    def run(self, once: bool = False) -> None:
        """To the end of the data; with ``once`` to the end of the open element."""
        if self.lex in ("key", "value") and not self.at and not self.string_end():
            raise _Ends
        while True:
            top = self.frames[-1] if self.frames else None
            if self.expect == "after" and top is not None and top.kind == "[":
                self._items()
            token = _TOKEN.match(self.data, self.at)
            if token is None:
                if _OPEN_STRING.match(self.data, self.at):
                    if self.expect not in ("key", "key or end", "either", "value", "item", "item or end"):
                        raise self.bad("a string")
                    self.lex = "either" if self.expect == "either" else "key" if self.expect.startswith("key") else "value"
                    self.open_string = True
                    raise _Ends
                raise self.bad("no token")
            if token.lastindex == _END_TOKEN:
                return
            if not self.known and len(self.frames) == 1:
                top.touched = top.touched or token[0].strip() not in (b"}", b"]")
            self._take(token)
            self.at = token.end()
            if once and self.record is None:
                return

    def _items(self) -> None:
        """Elements that are flat objects, many at once."""
        if self.found is not None and self._wanted():
            while item := _NEXT_FLAT.match(self.data, self.at):
                self.found.append(item.span(1))
                self.at = item.end()
        elif end := _MORE_FLAT.match(self.data, self.at).end() - self.at:
            self.at += end
            self.frames[-1].touched = True

    def _wanted(self) -> bool:
        return self.known and len(self.frames) == 2 and bool(self.frames[0].wanted) and self.frames[1].kind == "["

    def _take(self, token: re.Match) -> None:
        kind, expect = token.lastindex, self.expect
        if kind == _MARK_TOKEN:
            mark = token[_MARK_TOKEN]
            if mark in b"{[":
                self._value(token, mark.decode())
            elif mark in b"}]":
                self._close("{" if mark == b"}" else "[", token.end())
            elif mark == b":":
                if expect == "told":
                    self._kind("{")
                    self._key(self.last)
                elif expect != "colon":
                    raise self.bad("a colon")
                self.expect = "value"
            else:
                if expect == "told":
                    self._kind("[")
                elif expect != "after":
                    raise self.bad("a comma")
                of = self.frames[-1].kind if self.frames else None
                self.expect = {"{": "key", "[": "item", None: "either"}[of]
        elif kind == _STRING_TOKEN and expect in ("key", "key or end"):
            self._key(token[_STRING_TOKEN])
            self.expect = "colon"
        elif kind == _STRING_TOKEN and expect == "either":
            self.last, self.expect = token[_STRING_TOKEN], "told"
        else:
            self._value(token, None)

    def _key(self, string: bytes) -> None:
        self.frames[-1].wanted = json.loads(string) == self.key

    def _kind(self, kind: str) -> None:
        frame = self.frames[-1]
        if frame.kind not in (None, kind):
            raise self.bad("a mixed container")
        frame.kind = kind

    def _value(self, token: re.Match, opens: str | None) -> None:
        expect = self.expect
        begins = token.start(token.lastindex)
        if expect == "either":
            self._kind("[")
        elif expect == "start":
            if opens != "{" and token.lastindex != _FLAT_TOKEN:
                raise self.bad("no object")
        elif expect not in ("value", "item", "item or end"):
            raise self.bad("a value")
        top = self.frames[-1] if self.frames else None
        if self.known and len(self.frames) == 1 and top.wanted and opens != "[":
            raise ValueError(f"a document lacks the array {self.key}")
        if expect == "start" and opens is None:
            # The whole document is one flat object: its keys hold no array.
            self.expect = "end"
            return
        if expect == "value" and opens == "[" and top.wanted:
            top.arrays += 1
        element = self.found is not None and self._wanted()
        if opens:
            if element:
                self.record = begins
            self.frames.append(_Frame(opens))
            self.expect = "key or end" if opens == "{" else "item or end"
        else:
            if element:
                self.found.append((begins, token.end()))
            self.expect = "after"

    def _close(self, kind: str, end: int) -> None:
        if self.expect == "told" and kind == "[":
            self._kind("[")
        elif self.expect not in ("after", "key or end" if kind == "{" else "item or end"):
            raise self.bad("an end")
        if not self.frames:
            raise self.bad("an end")
        self._kind(kind)
        frame = self.frames.pop()
        if not self.frames and not self.known:
            self.closed.append(frame.told())
            self.frames.append(_Frame(None))
        elif not self.frames:
            self.top = frame
        self.expect = "after" if self.frames else "end"
        if self.record is not None and self._wanted():
            if self.record >= 0:
                self.found.append((self.record, end))
            self.record = None


class JsonLexer:
    """Elements of the array at a key of a document's top object.

    A state is [lex, open containers, whether the top object's last key is the wanted
    one, arrays seen there]; lex is start, text, end, or key or value for their strings.
    """

    SEPARATOR = b"}"
    START = ["start", "", None, 0]

    def __init__(self, key: str) -> None:
        self.key = key

    def summary(self, data: bytes, first: bool) -> dict:
        found = {"blank": not data.strip(b" \t\n\r")}
        for lex in ["start"] if first else ["text", "key", "value"]:
            walk = _JsonWalk(self, data, lex, [] if first else None)
            try:
                walk.run()
            except _Ends:
                pass
            except ValueError as error:
                found[lex] = str(error)
                continue
            kinds = [f.kind for f in walk.frames]
            if first:
                top = walk.frames[0] if walk.frames else walk.top
                inside = walk.lex if walk.lex in ("key", "value") else "text"
                found[lex] = [walk.expect if walk.expect in ("start", "end") else inside, "".join(kinds), top.wanted, top.arrays]
            else:
                found[lex] = [walk.lex, walk.closed, walk.frames[0].told(), "".join(kinds[1:])]
        return found

    def after(self, state: list, summary: dict) -> list:
        lex, stack, wanted, arrays = state
        if lex == "end":
            if not summary["blank"]:
                raise ValueError("a file does not hold one document")
            return state
        outcome = summary[lex]
        if isinstance(outcome, str):
            raise ValueError(outcome)
        if lex == "start":
            return outcome
        lex, closed, around, opened = outcome
        for i, (kind, key, seen, touched) in enumerate([*closed, around]):
            if not stack and (touched or i < len(closed)):
                raise ValueError("broken JSON: more follows the document")
            if kind and stack and stack[-1] != kind:
                raise ValueError("broken JSON: an end of the wrong kind")
            if len(stack) == 1:
                wanted, arrays = (wanted if key is None else key), arrays + seen
            if i < len(closed):
                stack = stack[:-1]
        stack += opened
        if lex == "either":  # a string of a container that the range did not open
            lex = "key" if stack[-1:] == "{" else "value"
        return [lex if stack else "end", stack, wanted, arrays]

    def finish(self, state: list) -> None:
        lex, _, _, arrays = state
        if lex != "end":
            raise ValueError("broken JSON: a document has no end")
        if not arrays:
            raise ValueError(f"a document lacks the array {self.key}")

    def cut(self, data: bytes, state: list, more: More) -> Iterator[tuple[str, str]]:
        lex, stack, wanted, _ = state
        frames = [_Frame(kind) for kind in stack]
        if frames:
            frames[0].wanted = wanted
        walk = _JsonWalk(self, data, lex, frames)
        walk.found = []
        if wanted and stack.startswith("{[") and len(stack) > 2:
            walk.record = -1
        try:
            walk.run()
        except _Ends:
            if walk.open_string and walk._wanted():
                raise ValueError("an element of the array is no object") from None
        while walk.record is not None and walk.record >= 0 and (beyond := more()):
            walk.data, walk.lex = walk.data + beyond, "text"
            try:
                walk.run(once=True)
            except _Ends:
                pass
        for begin, end in walk.found:
            yield self.key, walk.data[begin:end].decode()


# ---- XML

_SP = rb"[ \t\r\n]"
_NAME = rb"[A-Za-z_:\x80-\xff][^ \t\r\n/>=<\"'&]*+"
_REFERENCE = rb"&(?:amp|lt|gt|quot|apos|#[0-9]++|#x[0-9a-fA-F]++);"
_PLAIN = rb"(?:[^<&]++|%b)" % _REFERENCE
_COMMENT = rb"(?:[^-]++|-(?!-))*+"
_CDATA = rb"(?:[^\]]++|\](?!\]>))*+"
_NOTE = rb"(?:[^?]++|\?(?!>))*+"
_ATTRIBUTE = rb"%b++%b%b*+=%b*+(?:\"[^<\"]*+\"|'[^<']*+')" % (_SP, _NAME, _SP, _SP)
_DOCTYPE = rb"<!DOCTYPE[^\[<>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^\[<>\"']*+)*+>"
_XML_TOKEN = re.compile(
    rb"(%b++)|<!--%b-->|<!\[CDATA\[(%b)\]\]>|<\?%b\?>|(%b)|</(%b)%b*+>|<(%b)(?:%b)*+%b*+(/?)>|(\Z)"
    % (_PLAIN, _COMMENT, _CDATA, _NOTE, _DOCTYPE, _NAME, _SP, _NAME, _ATTRIBUTE, _SP)
)
_TEXT, _CDATA_TEXT, _DOCTYPE_TOKEN, _CLOSE, _OPEN, _EMPTY, _XML_END = 1, 2, 3, 4, 5, 6, 7
_XML_OPEN = re.compile(
    rb"<!--%b\Z()|<!\[CDATA\[%b\Z()|<\?%b\Z()|<(%b)(?:%b)*+%b++%b%b*+=%b*+(?:(\")[^<\"]*+\Z|(')[^<']*+\Z)"
    % (_COMMENT, _CDATA, _NOTE, _NAME, _ATTRIBUTE, _SP, _NAME, _SP, _SP)
)
# How the data goes on in each of the things it may start in, and how that ends.
_GOES_ON = {
    "comment": (re.compile(_COMMENT + rb"-->"), re.compile(_COMMENT + rb"\Z")),
    "cdata": (re.compile(_CDATA + rb"\]\]>"), re.compile(_CDATA + rb"\Z")),
    "note": (re.compile(_NOTE + rb"\?>"), re.compile(_NOTE + rb"\Z")),
    '"': (re.compile(rb"[^<\"]*+\"(?:%b)*+%b*+(/?)>" % (_ATTRIBUTE, _SP)), re.compile(rb"[^<\"]*+\Z")),
    "'": (re.compile(rb"[^<']*+'(?:%b)*+%b*+(/?)>" % (_ATTRIBUTE, _SP)), re.compile(rb"[^<']*+\Z")),
}


# The open value of a tag ends, and another one stays open.
_NEXT_VALUE = {
    quote: re.compile(
        rb"[^<%b]*+%b(?:%b)*+%b++%b%b*+=%b*+(?:(\")[^<\"]*+\Z|(')[^<']*+\Z)"
        % (quote.encode(), quote.encode(), _ATTRIBUTE, _SP, _NAME, _SP, _SP)
    )
    for quote in "\"'"
}
# Stands for the element whose start tag the range before began.
_OWN = "\0"


class _XmlWalk:
    """Tags in their order. Without ``stack`` the elements around the data are unknown."""

    def __init__(self, lexer: XmlLexer, data: bytes, lex: str, stack: list[str] | None, pending: str, root: bool) -> None:
        self.lexer, self.data, self.at, self.lex, self.pending = lexer, data, 0, lex, pending
        self.known, self.stack, self.root = stack is not None, list(stack or ()), root
        self.closed: list[str] = []
        self.own_end: str | None = None  # what ended the element whose tag was open
        # With a list here the children of the root are put there as (name, from, to).
        self.found: list[tuple[str, int, int]] | None = None
        self.record: int | None = None  # where the open child began; -1: before the data
        self.open_tag: int | None = None  # where a start tag began that goes on beyond the data

    def bad(self, what: str) -> ValueError:
        shown = self.data[self.at : self.at + 60].decode("utf-8", "replace")
        return ValueError(f"broken XML, {what}: {shown!r}")

    def run(self, once: bool = False) -> None:
        if self.lex != "text" and not self.at:
            end, inside = _GOES_ON[self.lex]
            found = end.match(self.data)
            if found is None:
                next_value = self.lex in "\"'" and _NEXT_VALUE[self.lex].match(self.data)
                if next_value:
                    self.lex = (next_value[1] or next_value[2]).decode()
                elif not inside.match(self.data):
                    raise self.bad(self.lex)
                raise _Ends
            if self.lex in "\"'":
                self._open(self.pending, bool(found[1]), -1, found.end())
            self.lex, self.at = "text", found.end()
        while True:
            if not self.known or len(self.stack) == 1:
                self._rows()
            token = _XML_TOKEN.match(self.data, self.at)
            if token is None:
                begun = _XML_OPEN.match(self.data, self.at)
                if begun is None:
                    raise self.bad("no token")
                self.lex = {1: "comment", 2: "cdata", 3: "note", 5: '"', 6: "'"}[begun.lastindex]
                self.pending = begun[4].decode() if begun[4] else ""
                self.open_tag = self.at if begun[4] else None
                raise _Ends
            kind = token.lastindex
            if kind == _XML_END:
                return
            if kind == _CLOSE:
                self._close(token[_CLOSE].decode(), token.end())
            elif kind in (_OPEN, _EMPTY):
                self._open(token[_OPEN].decode(), bool(token[_EMPTY]), token.start(), token.end())
            elif self.known and not self.stack:
                if kind in (_TEXT, _CDATA_TEXT) and token[0].strip():
                    raise self.bad("text outside the document")
            self.at = token.end()
            if once and self.record is None:
                return

    def _rows(self) -> None:
        """Flat rows, many at once."""
        if self.found is None:
            self.at = self.lexer.rows.match(self.data, self.at).end()
        else:
            while row := self.lexer.row_next.match(self.data, self.at):
                self.found.append((self.lexer.row, *row.span(1)))
                self.at = row.end()

    def _open(self, name: str, empty: bool, begin: int, end: int) -> None:
        if self.known and not self.stack:
            if self.root:
                raise self.bad("a second document")
            if name != self.lexer.root:
                raise ValueError(f"an element {name} stands where only {self.lexer.root} may")
        self.root = True
        element = self.found is not None and len(self.stack) == 1
        if empty:
            if element and begin >= 0:
                self.found.append((name, begin, end))
            return
        if element:
            self.record = begin
        self.stack.append(name)

    def _close(self, name: str, end: int) -> None:
        if self.stack:
            opened = self.stack.pop()
            if opened == _OWN:
                self.own_end = name
            elif opened != name:
                raise self.bad("an end tag that fits no start tag")
        elif self.known:
            raise self.bad("an end tag without a start tag")
        else:
            self.closed.append(name)
        if self.record is not None and len(self.stack) == 1:
            if self.record >= 0:
                self.found.append((name, self.record, end))
            self.record = None


class XmlLexer:
    """Children of a document's root element, by name.

    A state is [lex, open elements, the element whose start tag is open, whether there
    was a root, encoding]; lex is text, comment, cdata, note or an open quote of a tag.
    Documents must be in an encoding that has ASCII at its places. An internal DTD
    subset is refused.
    """

    SEPARATOR = b">"
    START = ["text", [], "", False, "utf-8"]

    def __init__(self, root: str, row: str, columns: Sequence[str]) -> None:
        self.root, self.row = root, row
        names = b"|".join(re.escape(c.encode()) for c in columns)
        cell = rb"%b*+(?:<(%b)>%b*+</\%d%b*+>|<(?:%b)%b*+/>)"
        tag = re.escape(row.encode())

        def flat(group: int) -> bytes:
            inner = cell % (_SP, names, _PLAIN, group, _SP, names, _SP)
            return rb"<%b>(?:%b)*+%b*+</%b%b*+>" % (tag, inner, _SP, tag, _SP)

        self.rows = re.compile(rb"(?:%b*+%b)*+" % (_SP, flat(1)))
        self.row_next = re.compile(rb"%b*+(%b)" % (_SP, flat(2)))

    def summary(self, data: bytes, first: bool) -> dict:
        found: dict = {"encoding": _encoding(data) if first else None}
        for lex in ["text"] if first else ["text", *_GOES_ON]:
            walk = _XmlWalk(self, data, lex, [] if first else None, _OWN, False)
            try:
                walk.run()
            except _Ends:
                pass
            except ValueError as error:
                found[lex] = str(error)
                continue
            found[lex] = [walk.lex, walk.closed, walk.stack, walk.pending, walk.own_end, walk.root]
        return found

    def after(self, state: list, summary: dict) -> list:
        lex, stack, pending, root, encoding = state
        outcome = summary[lex]
        if isinstance(outcome, str):
            raise ValueError(outcome)
        lex, closed, opened, begun, own_end, opens = outcome
        if own_end not in (None, pending):
            raise ValueError(f"broken XML: </{own_end}> ends <{pending}>")
        stack = [*stack]
        for name in closed:
            if not stack or stack.pop() != name:
                raise ValueError(f"broken XML: </{name}> ends nothing")
        stack += [pending if name == _OWN else name for name in opened]
        return [lex, stack, pending if begun == _OWN else begun, root or opens, summary["encoding"] or encoding]

    def finish(self, state: list) -> None:
        lex, stack, _, root, _ = state
        if lex != "text" or stack or not root:
            raise ValueError("broken XML: a document has no end")

    def cut(self, data: bytes, state: list, more: More) -> Iterator[tuple[str, str]]:
        lex, stack, pending, root, encoding = state
        if not root and not stack:
            encoding = _encoding(data) or encoding
        walk = _XmlWalk(self, data, lex, stack, pending, root)
        walk.found = []
        if len(stack) > 1:
            walk.record = -1
        try:
            walk.run()
        except _Ends:
            pass
        begun = walk.open_tag if len(walk.stack) == 1 else None  # a child, maybe an empty one
        while (begun is not None or (walk.record is not None and walk.record >= 0)) and (beyond := more()):
            walk.data, walk.lex = walk.data + beyond, "text"
            try:
                walk.run(once=True)
                begun = None
            except _Ends:
                begun = begun if walk.at == begun else None
        for name, begin, end in walk.found:
            yield name, walk.data[begin:end].decode(encoding)


def _encoding(data: bytes) -> str | None:
    """What the XML declaration says."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff") or b"\0" in data[:4]:
        raise ValueError("the encoding of an XML document has no ASCII")
    told = re.match(rb"\s*<\?xml[^>]*?encoding\s*=\s*[\"']([A-Za-z0-9._-]+)", data)
    return told[1].decode() if told else None


# ---- CSV

_FIELD_REST = re.compile(rb"(?:[^\"]++|\"\")*+\"")


class CsvLexer:
    """Records of a text with a header, each as a JSON object by the header's names.

    Line breaks in quotes belong to the record; a quote in quotes is doubled. Empty
    values are null, empty lines are left out. A state is "row" or "quoted", before a
    file's header "header".
    """

    SEPARATOR = b"\n"
    START = "header"

    def __init__(self, separator: str, names: Sequence[str]) -> None:
        self.separator, self.names = separator, list(names)
        other = rb"[^%b\r\n]" % re.escape(separator.encode())
        mark = rb"[%b\r\n]" % re.escape(separator.encode())
        self.fields = re.compile(rb"(?:(?:\"(?:[^\"]++|\"\")*+\"|(?!\")%b++|)%b)*+" % (other, mark))
        self.field = re.compile(rb"(?!\")%b*+\Z|\"(?:[^\"]++|\"\")*+\"\Z" % other)
        self.mark = re.compile(mark)

    def _end(self, data: bytes, lex: str) -> tuple[str, int]:
        """(state behind the data, where the field that is open there began)."""
        at = 0
        if lex == "quoted":
            rest = _FIELD_REST.match(data)
            if rest is None:
                return "quoted", 0
            at = rest.end()
            if at < len(data) and not self.mark.match(data, at):
                raise ValueError(f"'{self.separator}' expected after '\"' in a quoted field")
        end = self.fields.match(data, at).end()
        if end == len(data) or self.field.match(data, end):
            return "row", len(data)
        if data[end : end + 1] == b'"' and _FIELD_REST.match(data, end + 1) is None:
            return "quoted", end
        raise ValueError(f"'{self.separator}' expected after '\"' in a quoted field")

    def summary(self, data: bytes, first: bool) -> dict:
        found = {}
        for lex in ["header"] if first else ["row", "quoted"]:
            try:
                found[lex] = [self._end(data, lex)[0]]
            except ValueError as error:
                found[lex] = str(error)
        return found

    def after(self, state: str, summary: dict) -> str:
        if isinstance(summary[state], str):
            raise ValueError(summary[state])
        return summary[state][0]

    def finish(self, state: str) -> None:
        if state == "quoted":
            raise ValueError("unexpected end of data in quotes")

    def cut(self, data: bytes, state: str, more: More) -> Iterator[tuple[str, str]]:
        if state == "quoted":
            # The record that the range before began is cut there.
            rest = _FIELD_REST.match(data)
            end = rest and self._record_end(data, rest.end())
            if end is None:
                return
            data = data[end:]
        lex, at = self._end(data, "row")
        while lex == "quoted" and (beyond := more()):
            data += beyond
            rest = _FIELD_REST.match(data, at + 1)
            end = rest and self._record_end(data, rest.end())
            if end is not None:
                data, lex = data[:end], "row"
        text = io.StringIO(data.decode(), newline="")
        csv.field_size_limit(1 << 30)
        lines = (line for line in csv.reader(text, delimiter=self.separator, strict=True) if line)
        if state == "header":
            header = next(lines, None)
            if header is not None and header != self.names:
                raise ValueError(f"the header {header} is not the first file's {self.names}")
        for line in lines:
            values = {name: value or None for name, value in zip(self.names, line)}
            yield "", json.dumps(values, ensure_ascii=False)

    def _record_end(self, data: bytes, at: int) -> int | None:
        """Behind the line end that ends a record, from a place behind one of its fields."""
        while mark := self.mark.match(data, at):
            if mark[0] in b"\r\n":
                return at + (2 if data[at : at + 2] == b"\r\n" else 1)
            at += 1
            if data[at : at + 1] == b'"':
                rest = _FIELD_REST.match(data, at + 1)
                if rest is None:
                    return None
                at = rest.end()
            else:
                found = self.mark.search(data, at)
                at = found.start() if found else len(data)
        if at < len(data):
            raise ValueError(f"'{self.separator}' expected after '\"' in a quoted field")
        return None
