"""Cutting the members of a zip archive into records, inside tasks.

An archive is a format Spark cannot read, so this small part runs in Python: it
streams one member at a time and gives the text of one record after the other.
Nothing is held whole. Typing the records is Spark's work again.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs

_SPACE = re.compile(r"\s*")
_FOLLOWING = tuple(",:]} \t\r\n")
_BATCH_CHARS = 4 * 1024 * 1024


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a fully qualified path, and the name on it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    known_as = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{known_as}:{rest}")


def open_path(path: str) -> BinaryIO:
    """A seekable stream of a file on any file system that Arrow knows."""
    files, name = locate(path)
    return files.open_input_file(name)


class _Json:
    """Reads a JSON document from left to right in a sliding buffer."""

    def __init__(self, text: io.TextIOBase, chunk: int) -> None:
        self.text, self.chunk, self.buffer, self.at = text, chunk, "", 0
        self.decoder = json.JSONDecoder()

    def more(self) -> bool:
        held = self.buffer[self.at :]
        chunk = self.text.read(max(self.chunk, len(held)))
        self.buffer, self.at = held + chunk, 0
        return bool(chunk)

    def peek(self) -> str:
        """The next character that is not a space; empty at the end."""
        while True:
            self.at = _SPACE.match(self.buffer, self.at).end()
            if self.at < len(self.buffer):
                return self.buffer[self.at]
            if not self.more():
                return ""

    def take(self, *expected: str) -> str:
        char = self.peek()
        if char not in expected:
            raise ValueError(f"expected one of {expected} in the JSON document, found {char!r}")
        self.at += len(char)
        return char

    def value(self) -> str:
        """The text of the next value."""
        self.peek()
        while True:
            try:
                _, end = self.decoder.raw_decode(self.buffer, self.at)
            except ValueError:
                if not self.more():
                    raise
                continue
            # A number may go on until something that can follow a value is seen.
            if self.buffer[end : end + 1] not in _FOLLOWING and self.more():
                continue
            text, self.at = self.buffer[self.at : end], end
            return text


def json_records(stream: BinaryIO, key: str, chunk: int = 1 << 20) -> Iterator[str]:
    """The elements of the array at ``key`` of the document's top object."""
    document = _Json(io.TextIOWrapper(stream, encoding="utf-8-sig"), chunk)
    seen = False
    following = document.take("{")
    while following != "}":
        name = json.loads(document.value())
        document.take(":")
        if name == key:
            seen = True
            document.take("[")
            if document.peek() == "]":
                document.take("]")
            else:
                yield document.value()
                while document.take(",", "]") == ",":
                    yield document.value()
        else:
            document.value()
        following = document.take(",", "}")
    document.take("")
    if not seen:
        raise ValueError(f"a document lacks the array {key}")


# Flat records of plain text: no attributes, other references or names with a prefix.
_XML_TEXT = rb"(?:[^<&>\]\x00-\x08\x0b-\x1f\xef]++|&(?:amp|lt|gt|quot|apos);)*+"
_XML_CELL = rb"[ \t\n]*+<([A-Za-z_][A-Za-z0-9_.-]*+)>%b</\2>" % _XML_TEXT
_XML_ENCODING = re.compile(rb"\s*<\?xml[^>]*?encoding\s*=\s*[\"']([^\"']*)")


def xml_records(stream: BinaryIO, tag: str, root_tag: str | None = None, chunk: int = 1 << 20) -> Iterator[str]:
    """The ``tag`` elements of a document, as text; with ``root_tag`` the root is checked.

    Runs of flat records between two tags of the root are taken as they stand; the parser
    reads everything else, tag by tag.
    """
    name = re.escape(tag.encode())
    flat = re.compile(rb"[ \t\n]*+(<%b>(?:%b)*+[ \t\n]*+</%b>)" % (name, _XML_CELL, name))
    parser = ElementTree.XMLPullParser(("start", "end"))
    root, depth, between = None, 0, False
    buffer, at = stream.read(chunk), 0
    told = _XML_ENCODING.match(buffer.removeprefix(b"\xef\xbb\xbf"))
    plain = (told is None or told[1].lower() == b"utf-8") and buffer[:2] not in (b"\xff\xfe", b"\xfe\xff")
    while True:
        while between and (record := flat.match(buffer, at)):
            yield record[1].decode()
            at = record.end()
        if len(buffer) - at < chunk and (more := stream.read(chunk)):
            buffer, at = buffer[at:] + more, 0
            continue
        if at == len(buffer):
            break
        # Up to the next tag's end: where it tells of a tag, the document goes on behind that.
        end = buffer.find(b">", at) + 1 if plain else 0
        end = end or len(buffer)
        parser.feed(buffer[at:end])
        parser.flush()
        at, seen = end, False
        for event, element in parser.read_events():
            seen = True
            if event == "start":
                if root is None:
                    root = element
                    if root_tag not in (None, element.tag):
                        raise ValueError(f"an element {element.tag} stands where only {root_tag} may")
                if depth == 1 and element.tag != tag:
                    raise ValueError(f"an element {element.tag} stands where only {tag} may")
                depth += 1
                continue
            depth -= 1
            if depth == 1:
                element.tail = None
                yield ElementTree.tostring(element, encoding="unicode")
                root.clear()
        # A root in a namespace gives it to the records, too.
        between = plain and seen and depth == 1 and not root.tag.startswith("{")
    parser.close()


def csv_records(
    stream: BinaryIO, separator: str = "|", required: Sequence[str] = ()
) -> Iterator[str]:
    """The records of a text with a header, each as a JSON object by the header's names.

    Line breaks in quotes belong to the record; a quote in quotes is doubled. Empty
    values are null, empty lines are left out. A quote that never closes, and a header
    that lacks a required name, fail.
    """
    csv.field_size_limit(1 << 30)
    text = io.TextIOWrapper(stream, encoding="utf-8-sig", newline="")
    lines = (line for line in csv.reader(text, delimiter=separator, strict=True) if line)
    header = next(lines, None)
    if header is None:
        return
    missing = [name for name in required if name not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")
    for line in lines:
        yield json.dumps({name: value or None for name, value in zip(header, line)})


def member_lister(open_file: Callable[[str], BinaryIO]):
    """For ``mapInArrow``: archive paths in, one row per file in the archive out."""

    def list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as stream, zipfile.ZipFile(stream) as archive:
                    files = [i for i in archive.infolist() if not i.is_dir()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "archive": pa.array([path] * len(files), pa.string()),
                        "member": pa.array([i.filename for i in files], pa.string()),
                        "member_bytes": pa.array([i.file_size for i in files], pa.int64()),
                    }
                )

    return list_members


def record_cutter(
    open_file: Callable[[str], BinaryIO],
    cut: Callable[[BinaryIO], Iterator[str]],
):
    """For ``mapInArrow``: (archive, member) rows in, one row per record out."""

    def rows(archive: str, member: str, records: list[str]) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_pydict(
            {
                "archive": pa.array([archive] * n, pa.string()),
                "member": pa.array([member] * n, pa.string()),
                "record": pa.array(records, pa.string()),
            }
        )

    def cut_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["archive", "member"]).to_pylist():
                path, member = row["archive"], row["member"]
                with (
                    open_file(path) as stream,
                    zipfile.ZipFile(stream) as archive,
                    archive.open(member) as content,
                ):
                    held, chars = [], 0
                    for record in cut(content):
                        held.append(record)
                        chars += len(record)
                        if chars >= _BATCH_CHARS:
                            yield rows(path, member, held)
                            held, chars = [], 0
                    if held:
                        yield rows(path, member, held)

    return cut_members
