"""Documents of all kinds, cut in any number of ranges, against whole-document parsers."""

import csv
import io
import json
from xml.etree import ElementTree

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citewise.sources.lexers import CsvLexer, JsonLexer, XmlLexer
from citewise.sources.ranges import _Range


def told(value):
    """What is left of a value on its way to another task."""
    return json.loads(json.dumps(value))


def cut(lexer, data, step):
    """The records of a file that is read in ranges of `step` bytes."""
    size = len(data)
    ranges = [(at, min(at + step, size)) for at in range(0, max(size, 1), step)]

    def part(start, stop):
        return _Range(io.BytesIO(data), start, stop, size, lexer.SEPARATOR)

    state, found = lexer.START, []
    states = []
    for start, stop in ranges:
        states.append(told(state))
        state = lexer.after(states[-1], told(lexer.summary(part(start, stop).data, start == 0)))
    lexer.finish(told(state))
    for (start, stop), state in zip(ranges, states):
        piece = part(start, stop)
        found += lexer.cut(piece.data, state, piece.more)
    return found


def outcome(work):
    try:
        return work()
    except (ValueError, csv.Error, ElementTree.ParseError):
        return "broken"


steps = st.sampled_from([1, 2, 3, 5, 13, 50, 10_000])
damage = st.none() | st.tuples(st.floats(0, 1), st.sampled_from(list('{}[]",:\\<>/&-|\nx')), st.booleans())


def damaged(data, how):
    """One character put in, or in another's place."""
    if how is None:
        return data
    at = int(how[0] * len(data))
    return data[:at] + how[1].encode() + data[at + how[2] :]


texts = st.text('a"}\\{][,:ü\n', max_size=6)
values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | texts,
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(texts | st.just("t"), inner, max_size=3),
    max_leaves=12,
)
objects = st.dictionaries(texts, values, max_size=4)


@given(st.lists(st.none() | objects, max_size=6), st.dictionaries(texts, values, max_size=3), st.sampled_from([None, 1]), steps, damage)
@settings(deadline=None, max_examples=400)
def test_json_in_any_ranges(elements, others, indent, step, how):
    document = {**others, "t": elements, "z}": others}
    data = damaged(json.dumps(document, indent=indent, ensure_ascii=False).encode(), how)

    def whole():
        keys = []
        parsed = json.loads(data, object_pairs_hook=lambda pairs: keys.append([k for k, _ in pairs]) or dict(pairs))
        if not isinstance(parsed, dict) or not isinstance(parsed.get("t"), list) or keys[-1].count("t") > 1:
            raise ValueError
        return parsed["t"]

    expected = outcome(whole)
    found = outcome(lambda: [json.loads(text) for _, text in cut(JsonLexer("t"), data, step)])
    if found != expected:
        # Elements that are no objects are refused later, or here if they are cut.
        assert how is not None
        odd = expected if expected != "broken" else found
        duplicates = data.count(b'"t"') > json.dumps(document).count('"t"')
        assert duplicates or any(not isinstance(e, dict | None) for e in odd)


inner = st.sampled_from(["", "x", "1 &amp; 2", " y>z ", "ü", "<![CDATA[<a> >]]>", "<!-- </a> <a> -->", "<?n a>b?>", "&#65;", "]] >"])
attributes = st.sampled_from(["", "", ' k="a>b"', " k='>' j=\"1\"", ' j=">" k=\'">\''])
cells = st.builds(lambda n, a, t, u: f" <{n}{a}>{t}{u}</{n} >", st.sampled_from("pvc"), attributes, inner, inner) | st.builds(
    lambda n, a: f"<{n}{a}/>", st.sampled_from("pvc"), attributes
)
elements = st.builds(lambda a, c: f"<a{a}>{''.join(c)}</a>", attributes, st.lists(cells, max_size=4)) | st.builds(lambda a: f"<a{a}/>", attributes)
between = st.sampled_from(["", "\n", "<!-- <a> > -->", "<?p > ?>"])


@given(st.lists(st.tuples(between, elements), max_size=5), st.sampled_from(["", "<?xml version='1.0'?>\n", "<!-- > -->", "<!DOCTYPE as>"]), between, steps, damage)
@settings(deadline=None, max_examples=400)
def test_xml_in_any_ranges(parts, head, tail, step, how):
    text = head + "<as>" + "".join(b + e for b, e in parts) + "</as>" + tail
    data = damaged(text.encode(), how)

    def whole():
        root = ElementTree.fromstring(data.decode())
        if root.tag != "as":
            raise ValueError
        return [(child.tag, "".join(child.itertext())) for child in root]

    def ranged():
        found = cut(XmlLexer("as", "a", ["p", "v", "c"]), data, step)
        return [(name, "".join(ElementTree.fromstring(record).itertext())) for name, record in found]

    expected, found = outcome(whole), outcome(ranged)
    # Rules of names, attributes and declarations are left to the parser of the records.
    assert found == expected or (how is not None and expected == "broken")


fields = st.text('ab"|\n\r ü', max_size=4)


@given(st.lists(st.lists(fields, min_size=1, max_size=3), max_size=6), st.sampled_from(["\n", "\r\n", "\r"]), st.booleans(), steps, damage)
@settings(deadline=None, max_examples=400)
def test_csv_in_any_ranges(lines, end, quoted, step, how):
    text = io.StringIO(newline="")
    writer = csv.writer(text, delimiter="|", lineterminator=end, quoting=csv.QUOTE_ALL if quoted else csv.QUOTE_MINIMAL)
    writer.writerows([["h", "i"], *lines])
    data = damaged(text.getvalue().encode(), how)

    def whole():
        rows = [r for r in csv.reader(io.StringIO(data.decode(), newline=""), delimiter="|", strict=True) if r]
        if rows and rows[0] != ["h", "i"]:
            raise ValueError
        return [{n: v or None for n, v in zip(["h", "i"], r)} for r in rows[1:]]

    assert outcome(lambda: [json.loads(r) for _, r in cut(CsvLexer("|", ["h", "i"]), data, step)]) == outcome(whole)


@pytest.mark.parametrize("size", [0, 1, 200_000])
def test_long_strings_and_comments_over_many_ranges(size):
    text = "}" * size
    data = json.dumps({text: text, "t": [{"a": text, "b": [text]}, {}]}).encode()
    assert [json.loads(r) for _, r in cut(JsonLexer("t"), data, 50_000)] == [{"a": text, "b": [text]}, {}]
    comment = f"<!--{'>' * size}-->"
    data = f"<as>{comment}<a>{comment}<p>{'>' * size}</p></a>{comment}<a/></as>{comment}".encode()
    found = cut(XmlLexer("as", "a", ["p"]), data, 50_000)
    assert [r for _, r in found] == [f"<a>{comment}<p>{'>' * size}</p></a>", "<a/>"]


def test_utf_16_and_an_inner_dtd_are_refused():
    for data in ("<as/>".encode("utf-16"), b"<!DOCTYPE as [<!ENTITY x '1'>]><as/>"):
        with pytest.raises(ValueError):
            cut(XmlLexer("as", "a", ["p"]), data, 1000)
