"""HTML handling on the standard library's parser: text extraction, attribute stripping and size-bounded splitting."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

BLOCKS = frozenset("address article aside blockquote body div dl dt dd fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset(("script", "style", "template", "noscript"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_TAG = re.compile(r"<[A-Za-z/!][^>]*>")


def is_html(text: str | None) -> bool:
    return bool(text) and _TAG.search(text) is not None


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in SILENT:
            self.silent += 1
        elif tag == "br":
            self.out.append("\n")
        elif tag in BLOCKS:
            self.out.append("\n* " if tag == "li" else f"\n\n{'#' * int(tag[1])} " if re.fullmatch("h[1-6]", tag) else "\n\n")

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCKS and tag != "li":
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.silent:
            self.out.append(re.sub(r"\s+", " ", data))


def html_to_text(text: str | None) -> str | None:
    """Words without markup; links keep their words only, blocks are set apart by blank lines."""
    if text is None:
        return None
    parser = _Text()
    parser.feed(text)
    parser.close()
    lines = [line.strip() for line in "".join(parser.out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


class _Rewriter(HTMLParser):
    """Writes the document again, each start tag as ``keep`` says."""

    def __init__(self, keep) -> None:
        super().__init__(convert_charrefs=False)
        self.keep, self.out = keep, []

    def handle_starttag(self, tag, attrs):
        kept = self.keep(tag, attrs)
        if kept is not None:
            self.out.append(f"<{tag}" + "".join(f' {k}="{escape(v)}"' if v is not None else f" {k}" for k, v in kept) + ">")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.keep(tag, []) is not None:
            self.out.append(f"</{tag}>")

    def handle_data(self, data):
        self.out.append(data)

    def handle_entityref(self, name):
        self.out.append(f"&{name};")

    def handle_charref(self, name):
        self.out.append(f"&#{name};")


def _rewrite(text: str, keep) -> str:
    parser = _Rewriter(keep)
    parser.feed(text)
    parser.close()
    return "".join(parser.out)


def strip_attributes(text: str | None) -> str | None:
    """No attributes but those of images with a source and links with a target, which keep all of theirs."""
    if not is_html(text):
        return text
    named = {"img": "src", "a": "href"}
    return _rewrite(text, lambda tag, attrs: attrs if any(k == named.get(tag) for k, _ in attrs) else [])


_SECTIONS = ("h2", "h3", "h4", "h5", "h6")


def _pieces(text: str, tag: str) -> list[str]:
    """Cut before each opening of a tag."""
    return [p for p in re.split(rf"(?=<{tag}[\s>])", text) if p.strip()]


def _table_rows(piece: str, size: int) -> list[str]:
    """A table cut between rows, its head and its own tags repeated in each part; what stands before, between and behind its rows is a piece of its own."""
    opened, closed = re.search(r"<table[\s>]", piece), piece.rfind("</table>")
    if not opened or closed < opened.start():
        return [piece]
    before, table, behind = piece[: opened.start()], piece[opened.start() : closed], piece[closed + len("</table>") :]
    head = re.search(r"<thead[\s>].*?</thead>", table, re.S)
    body = table[: head.start()] + table[head.end() :] if head else table
    rows = list(re.finditer(r"<tr[\s>].*?</tr>", body, re.S))
    if len(rows) < 2:
        return [piece]
    own = re.compile(r"</?(?:table|tbody)(?:\s[^>]*)?>")
    frame = lambda held: f"<table>{head[0] if head else ''}<tbody>{held}</tbody></table>"
    out, held, at = [before], "", 0
    for row in rows:
        aside = own.sub("", body[at : row.start()])
        if held and (aside.strip() or len(frame(held + row[0])) > size):
            out.append(frame(held))
            held = ""
        out.append(aside)
        held, at = held + row[0], row.end()
    return [p for p in (*out, frame(held), own.sub("", body[at:]), behind) if p.strip()]


def fill(pieces: list[str], size: int, length=len, joint: str = "") -> list[str]:
    """Neighbouring pieces put together as long as they fit."""
    out: list[str] = []
    for piece in pieces:
        if out and length(out[-1] + joint + piece) <= size:
            out[-1] += joint + piece
        else:
            out.append(piece)
    return out


def split_html(text: str, size: int, overlap: int, length=len) -> list[str]:
    """Parts of at most ``size``: whole if it fits, else by headings, tables' rows, paragraphs, and at last plain text."""
    from docloom.functions.splitters import recursive_split

    clean = _rewrite(text, lambda tag, attrs: None if tag == "span" else [])
    clean = re.sub(r"<(p|div|li|b|i|em|strong|u)>\s*</\1>", "", clean)
    if length(clean) <= size:
        return [clean] if clean.strip() else []
    pieces = [clean]
    for tag in (*_SECTIONS, "table", "p"):
        pieces = [part for piece in pieces for part in (_pieces(piece, tag) if length(piece) > size else [piece])]
        if tag == "table":
            pieces = [part for piece in pieces for part in (_table_rows(piece, size) if length(piece) > size and "<table" in piece else [piece])]
    out: list[str] = []
    for piece in fill(pieces, size, length):
        out += [piece] if length(piece) <= size else recursive_split(html_to_text(piece) or "", size, overlap, length=length)
    return out
