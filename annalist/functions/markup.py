"""Markup functions that regular expressions cannot express, as Arrow UDFs and one table function.

The block scanner knows fences, indented code, block quotes and headings; it is
a subset of CommonMark and leaves list nesting and setext headings alone.
"""

from __future__ import annotations

import html
import html.entities
import re
import tomllib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
#: Deepest nesting of block quotes and elements before a text counts as unreadable.
DEEPEST = 64
_TAG = re.compile(r"<(/?)([A-Za-z][\w:.-]*)((?:\s+[\w:.@{}-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|\{[^}]*\}|[^\s\"'=<>`]+))?)*)\s*(/?)>")
_ATTRIBUTE = re.compile(r"\s+([\w:.@-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|\{([^}]*)\}|([^\s\"'=<>`{}]+)))?")


@dataclass
class Token:
    """A piece of markup with its place: kind is open, close, empty or comment."""

    kind: str
    name: str
    raw: str
    start: int
    end: int
    escaped: bool


def tokens(text: str) -> list[Token]:
    """Tags and comments in order; a backslash before one (an odd number of them) escapes it."""
    out, at = [], 0
    while (at := text.find("<", at)) >= 0:
        slashes = at
        while slashes and text[slashes - 1] == "\\":
            slashes -= 1
        escaped = (at - slashes) % 2 == 1
        if text.startswith("<!--", at):
            stop = text.find("-->", at + 4)
            end = len(text) if stop < 0 else stop + 3
            out.append(Token("comment", "", text[at:end], at, end, escaped))
        elif m := _TAG.match(text, at):
            end = m.end()
            name = m[2]
            kind = "close" if m[1] else "empty" if m[4] or name.lower() in VOID else "open"
            out.append(Token(kind, name, m[0], at, end, escaped))
        else:
            end = at + 1
        at = end
    return out


def attribute_forms(tag: str) -> list[tuple[str, str, str | None]] | None:
    """(name, form, value) of the attributes of one opening tag; form is bare, quoted (twice), single, braced or plain. Null where anything else stands in it or a name is repeated."""
    m = _TAG.fullmatch(tag)
    if not m or m[1]:
        return None
    out, at = [], 0
    while at < len(m[3]):
        a = _ATTRIBUTE.match(m[3], at)
        if not a:
            return None
        told = [(form, v) for form, v in zip(("quoted", "single", "braced", "plain"), a.groups()[1:], strict=True) if v is not None]
        form, value = told[0] if told else ("bare", None)
        out.append((a[1], form, value and html.unescape(value)))
        at = a.end()
    return out if len({name for name, _, _ in out}) == len(out) else None


def attributes(tag: str) -> dict[str, str | None] | None:
    """The attributes of one tag; null where anything else stands in it or a name is repeated."""
    forms = attribute_forms(tag)
    return None if forms is None else {name: value for name, _, value in forms}


def between_tags(text: str) -> str:
    """text with every tag and comment blanked, all else at its place."""
    out, at = [], 0
    for t in tokens(text):
        out += [text[at : t.start], re.sub(r"[^\n]", " ", t.raw)]
        at = t.end
    return "".join([*out, text[at:]])


def unfinished(text: str) -> bool:
    """Whether text ends within a tag or a comment."""
    found = tokens(text)
    if any(t.kind == "comment" and not t.raw.endswith("-->") for t in found):
        return True
    rest = text[found[-1].end if found else 0 :]
    return re.search(r"(?<!\\)(?:\\\\)*<[A-Za-z/!?][^>]*\Z", rest) is not None


def without_spans(text: str, spans: list[tuple[int, int]], keep_lines: bool = False) -> str:
    """text without the spans (which may overlap); with keep_lines their line ends stay."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b <= at:
            continue
        a = max(a, at)
        out.append(text[at:a])
        if keep_lines:
            out.append("\n" * text.count("\n", a, b))
        at = b
    return "".join([*out, text[at:]])


def replaced_spans(text: str, spans: list[tuple[int, int]], put: str) -> str:
    """text with put in place of each of the spans (one of those that overlap)."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def without_comments(text: str) -> str:
    """A blank line in place of each comment; what looks like one in an attribute or after a backslash stays."""
    return replaced_spans(text, [(t.start, t.end) for t in tokens(text) if t.kind == "comment" and not t.escaped], "\n\n")


def unfinished(text: str) -> str | None:
    """The tag or comment that a text breaks off in, from its < on; null where it ends outside of any."""
    at, end = text.rfind("<"), 0
    for t in tokens(text):
        end = max(end, t.end)
        if t.kind == "comment" and not t.raw.endswith("-->"):
            return t.raw
    return text[at:] if at >= end and re.match(r"</?[A-Za-z][^<>]*\Z", text[at:]) else None


_FENCE = re.compile(r"( {0,3})(`{3,}|~{3,})[ \t]*(.*?)[ \t]*\Z")
_ITEM = re.compile(r"( {0,3})(?:[-+*]|([0-9]{1,9})[.)])(?=[ \t]|\Z)")
_RULE = re.compile(r" {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})\Z")
_HEADING, _UNDERLINE, _QUOTE = re.compile(r" {0,3}#{1,6}(?:[ \t]|\Z)"), re.compile(r" {0,3}(?:=+|-+)[ \t]*\Z"), re.compile(r" {0,3}> ?")


def _opens_fence(row: str):
    m = _FENCE.match(row)
    return m if m and not (m[2][0] == "`" and "`" in m[3]) else None


def _interrupts(row: str) -> bool:
    """Whether a line begins a block of its own although a paragraph is open."""
    item = _ITEM.match(row)
    return bool(_opens_fence(row) or _HEADING.match(row) or _RULE.match(row) or _QUOTE.match(row) or (item and item[2] in (None, "1") and row[item.end() :].strip()))


class _TooDeep(Exception):
    pass


def _scan(rows: list[str], first: int, depth: int, out: list[tuple[int, int, str, str]]) -> bool:
    """Blocks of the lines of one container, those of the containers in it too; whether a paragraph is open at the end."""
    if depth >= DEEPEST:
        raise _TooDeep
    i, paragraph = 0, False
    while i < len(rows):
        row = rows[i]
        if not row.strip():
            i, paragraph = i + 1, False
        elif not paragraph and row.startswith("    "):
            j = i
            while j < len(rows) and (rows[j].startswith("    ") or not rows[j].strip()):
                j += 1
            while not rows[j - 1].strip():
                j -= 1
            out.append((first + i, first + j, "code", ""))
            i = j
        elif m := _opens_fence(row):
            j = i + 1
            while j < len(rows) and not re.match(rf" {{0,3}}{re.escape(m[2][0])}{{{len(m[2])},}}[ \t]*\Z", rows[j]):
                j += 1
            j = min(j + 1, len(rows))
            out.append((first + i, first + j, "fence" if depth == 0 else "inner-fence", m[3]))
            i, paragraph = j, False
        elif _QUOTE.match(row):
            inner, j = [], i
            while j < len(rows) and (m := _QUOTE.match(rows[j])):
                inner.append(rows[j][m.end() :])
                j += 1
            own: list[tuple[int, int, str, str]] = []
            paragraph = _scan(inner, first + i, depth + 1, own)
            # lines that go on a paragraph need no mark
            while paragraph and j < len(rows) and rows[j].strip() and not _interrupts(rows[j]):
                j += 1
            out += [(first + i, first + j, "quote", ""), *own]
            if j < len(rows) and _QUOTE.match(rows[j]):
                rows = [*rows[:i], *["> " + r if not _QUOTE.match(r) else r for r in rows[i:j]], *rows[j:]]
                del out[-len(own) - 1 :]
                continue
            i, paragraph = j, False
        elif (m := _ITEM.match(row)) and not _RULE.match(row) and not (paragraph and not _interrupts(row)):
            rest = row[m.end() :]
            gap = len(rest) - len(rest.lstrip(" "))
            width = m.end() + (gap if 1 <= gap <= 4 and rest.strip() else 1)
            inner, j = [row[width:]], i + 1
            while j < len(rows):
                if rows[j].startswith(" " * width):
                    inner.append(rows[j][width:])
                elif not rows[j].strip() and (len(inner) > 1 or inner[0].strip()):
                    inner.append("")
                elif rows[j].strip() and not _interrupts(rows[j]) and not _ITEM.match(rows[j]) and rows[j - 1].strip() and _scan(inner, 0, depth + 1, []):
                    while j < len(rows) and rows[j].strip() and not _interrupts(rows[j]) and not _ITEM.match(rows[j]):
                        inner.append(rows[j].lstrip(" "))
                        j += 1
                    continue
                else:
                    break
                j += 1
            _scan(inner, first + i, depth + 1, out)
            i, paragraph = j, False
        else:
            paragraph = not (_HEADING.match(row) or _RULE.match(row) or (paragraph and _UNDERLINE.match(row)))
            i += 1
    return paragraph


def line_blocks(text: str) -> list[tuple[int, int, str, str]] | None:
    """(first line, end line, kind, info) of fences, indented code and block quotes as CommonMark reads them, in lists and quotes too.

    A fence within another block is an inner-fence. Null when blocks nest too deep.
    """
    out: list[tuple[int, int, str, str]] = []
    try:
        _scan([row.expandtabs(4) if row[: len(row) - len(row.lstrip())].count("\t") else row for row in text.split("\n")], 0, 0, out)
    except _TooDeep:
        return None
    return sorted(out)


def without_blocks(text: str, kinds: frozenset[str] = frozenset({"fence", "inner-fence", "code", "quote"}), keep_info: str | None = None) -> str | None:
    """text with the lines of such blocks emptied; the body of a single fence of keep_info stays."""
    found = line_blocks(text)
    if found is None:
        return None
    kept = [b for b in found if b[2] == "fence" and b[3].split(" ")[0] == keep_info]
    spared = kept if len(kept) == 1 else []
    rows = text.split("\n")
    for block in found:
        if block in spared:
            rows[block[0]] = rows[block[1] - 1] = ""  # the fence's own lines
        elif block[2] in kinds:
            rows[block[0] : block[1]] = [""] * (block[1] - block[0])
    return "\n".join(rows)


#: Fixed value: elements whose content is no prose.
RAW = frozenset({"blockquote", "code", "iframe", "noembed", "noframes", "noscript", "plaintext", "pre", "script", "style", "template", "textarea", "title", "xmp"})
_INLINE = re.compile(r"(?<!`)(`+)(?!`)(.*?)(?<!`)\1(?!`)", re.S)


def without_code(text: str, keep_info: str | None = None) -> str | None:
    """Prose only: no code blocks, quotes, comments, raw containers or inline code but single words.

    Null where blocks nest too deep or the text breaks off in the tag of a raw container.
    """
    bare = without_blocks(text, frozenset({"fence", "inner-fence", "code"}), keep_info)
    if bare is None:
        return None
    word = lambda m: m[2].strip() and "\n" not in m[2] and "\r" not in m[2] and not re.search(r"[<>\s]", m[2].strip())
    bare = _INLINE.sub(lambda m: m[0] if word(m) else "\n\n", without_comments(bare))
    if (tail := unfinished(bare)) and (m := re.match(r"</?([A-Za-z]+)", tail)) and m[1].lower() in RAW:
        return None
    spans, open_ = [], []
    for t in tokens(bare):
        name = t.name.lower()
        if t.escaped or name not in RAW:
            continue
        if t.kind == "open":
            open_.append((name, t.start))
            if name == "plaintext":
                break
        elif t.kind == "close" and open_ and open_[-1][0] == name:
            start = open_.pop()[1]
            if not open_:
                spans.append((start, t.end))
        elif not open_:
            spans.append((t.start, t.end))
    if open_:
        spans.append((open_[0][1], len(bare)))
    return without_blocks(replaced_spans(bare, spans, "\n\n"), frozenset({"quote"}))


def without_links(text: str) -> str:
    """Link texts stay; targets, images, automatic links and reference definitions go."""
    text = re.sub(r"(?m)^ {0,3}\[[^\]]+\]:\s*\S+.*$", "", text)
    text = re.sub(r"!\[[^\]]*\](?:\([^)]*\)|\[[^\]]*\])?", "", text)
    text = re.sub(r"\[([^\]]+)\](?:\((?:[^()]|\([^()]*\))*\)|\[[^\]]*\])", r"\1", text)
    return re.sub(r"<(?:https?|mailto):[^>\s]+>", "", text)


def without_elements(text: str, names: frozenset[str]) -> str | None:
    """text without the whole elements of these names; null where they are not balanced."""
    spans, open_ = [], []
    for t in tokens(text):
        if t.escaped or t.name not in names:
            continue
        if t.kind == "open":
            open_.append(t)
            if len(open_) > DEEPEST:
                return None
        elif t.kind == "close":
            if not open_ or open_[-1].name != t.name:
                return None
            first = open_.pop()
            if not open_:
                spans.append((first.start, t.end))
        else:
            spans.append((t.start, t.end))
    return None if open_ else without_spans(text, spans)


def section(text: str, title: str) -> str:
    """Body of the only active second-level heading of this title, up to the next of its level or above; else empty."""
    bare = without_blocks(text)
    if bare is None:
        return ""
    rows, shown = text.split("\n"), bare.split("\n")
    heads = [(i, len(m[1]), m[2].strip()) for i, row in enumerate(shown) if (m := re.match(r"^ {0,3}(#{1,6})\s+(.*?)\s*#*\s*$", row))]
    own = [k for k, (_, level, name) in enumerate(heads) if level == 2 and name == title]
    if len(own) != 1:
        return ""
    start = heads[own[0]][0] + 1
    stop = next((i for i, level, _ in heads[own[0] + 1 :] if level <= 2), len(rows))
    return "\n".join(rows[start:stop])


def element_tags(text: str, name: str) -> list[str]:
    """Opening and empty tags of an element that are active: not escaped, in code, a comment or a quote."""
    bare = without_code(text)
    return [] if bare is None else [t.raw for t in tokens(bare) if t.name == name and t.kind in ("open", "empty") and not t.escaped]


def request_lines(text: str, method: str = "POST") -> list[str]:
    """Targets of active request lines, one HTTP fence included."""
    bare = without_code(text, keep_info="http")
    return [] if bare is None else re.findall(rf"(?m)^\s*{method}\s+(\S+)\s*(?:HTTP/[\d.]+)?\s*$", bare)


def toml_value(text: str, key: str) -> str | None:
    """A static string of [project]; null where the file is invalid, the key is dynamic or no string."""
    try:
        project = tomllib.loads(text).get("project")
    except (tomllib.TOMLDecodeError, RecursionError):
        return None
    if not isinstance(project, dict) or key in (project.get("dynamic") or []):
        return None
    value = project.get(key)
    return value if isinstance(value, str) else None


def strict_yaml(text: str):
    """A YAML document without anchors, aliases, tags of its own or repeated keys; null for anything else."""
    import yaml

    class Strict(yaml.SafeLoader):
        def compose_node(self, parent, index):
            if self.check_event(yaml.AliasEvent) or getattr(self.peek_event(), "anchor", None):
                raise yaml.YAMLError("anchors are not read")
            return super().compose_node(parent, index)

        def construct_mapping(self, node, deep=False):
            keys = [self.construct_object(k, deep=True) for k, _ in node.value]
            if len({repr(k) for k in keys}) != len(keys):
                raise yaml.YAMLError("repeated key")
            return super().construct_mapping(node, deep)

    try:
        return yaml.load(text, Strict)  # noqa: S506 - a SafeLoader
    except (yaml.YAMLError, RecursionError):
        return None


#: Values of an Arrow batch that are Python objects at a time; a batch of long texts, or of what is found in them, is much larger than its buffers.
SLICE = 64


def by_slices(function, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """The results of function over the rows of Arrow arrays, made and put away slice by slice."""
    parts = [pa.array([function(*row) for row in zip(*[c.slice(at, SLICE).to_pylist() for c in columns], strict=True)], kind) for at in range(0, len(columns[0]), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _mapped(function, kind):
    """An Arrow UDF that applies a text function to every value that is not null."""

    def run(values: pa.Array) -> pa.Array:
        return by_slices(lambda v: None if v is None else function(v), _ARROW[kind.simpleString()], values)

    return F.arrow_udf(run, kind)


_ARROW = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "map<string,string>": pa.map_(pa.string(), pa.string())}


#: A character reference with the semicolon that ends it.
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def terminated_references(text: str) -> str:
    """text with the references that end in a semicolon as characters; what only begins like one stays."""
    return _REFERENCE.sub(lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0], text)


def unescape(c: Column, terminated: bool = False) -> Column:
    """HTML character references as characters; if terminated, only those that end in a semicolon."""
    return _mapped(terminated_references if terminated else html.unescape, StringType())(c)


def prose(c: Column, keep_info: str | None = None) -> Column:
    return _mapped(lambda t: without_code(t, keep_info), StringType())(c)


def uncommented(c: Column) -> Column:
    return _mapped(without_comments, StringType())(c)


def unlinked(c: Column) -> Column:
    return _mapped(without_links, StringType())(c)


def without(c: Column, names: list[str]) -> Column:
    own = frozenset(names)
    return _mapped(lambda t: without_elements(t, own), StringType())(c)


def section_of(c: Column, title: str) -> Column:
    return _mapped(lambda t: section(t, title), StringType())(c)


def tags_of(c: Column, name: str) -> Column:
    return _mapped(lambda t: element_tags(t, name), ArrayType(StringType()))(c)


def requests_of(c: Column, method: str = "POST") -> Column:
    return _mapped(lambda t: request_lines(t, method), ArrayType(StringType()))(c)


def attributes_of(c: Column) -> Column:
    return _mapped(lambda t: None if (a := attributes(t)) is None else [*a.items()], MapType(StringType(), StringType()))(c)


def toml_of(c: Column, key: str) -> Column:
    return _mapped(lambda t: toml_value(t, key), StringType())(c)


def yaml_json(c: Column) -> Column:
    """A strict YAML document as canonical JSON, null for anything else."""
    import json

    def run(t: str) -> str | None:
        found = strict_yaml(t)
        return None if found is None else json.dumps(found, sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=str)

    return _mapped(run, StringType())(c)


TOKEN = StructType([StructField("kind", StringType()), StructField("name", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("escaped", StringType())])


def tokens_of(c: Column) -> Column:
    """array<struct(kind, name, start, end, escaped)> of a text's markup, for explode()."""

    def run(values: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("name", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("escaped", pa.string())]))
        row = lambda v: None if v is None else [{"kind": t.kind, "name": t.name, "start": t.start, "end": t.end, "escaped": str(t.escaped).lower()} for t in tokens(v)]
        return by_slices(row, kind, values)

    return F.arrow_udf(run, ArrayType(TOKEN))(c)


def clean(c: Column, terminated: bool = False, emphasis: bool = True) -> Column:
    """Markdown as prose: plain() and then character references resolved, as unescape() does."""
    from .text import plain

    return unescape(plain(c, emphasis), terminated)
