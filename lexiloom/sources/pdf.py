"""Text of PDF files: by a PDF library where one is installed, else by a reader of the common subset.

The built-in reader takes files whose objects are plain or in object streams, with streams that are raw or deflated, and fonts
of one-byte codes or with a ToUnicode table. Encrypted files and other filters raise; scanned pages have no text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj\b", re.S)
_STREAM = re.compile(rb"stream\r?\n")
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
_SHOW = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+\d?\*?|<<|>>", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: A gap of so many thousandths of the type size between two shown strings parts words.
GAP = 200


class PdfError(ValueError):
    pass


def _stream(body: bytes) -> bytes | None:
    m = _STREAM.search(body)
    if not m:
        return None
    head, end = body[: m.start()], body.rfind(b"endstream")
    raw = body[m.end() : end if end >= 0 else len(body)]
    if (n := re.search(rb"/Length\s+(\d+)\b(?!\s+\d+\s+R)", head)) and int(n[1]) <= len(raw):
        raw = raw[: int(n[1])]
    filters = re.search(rb"/Filter\s*(\[[^\]]*\]|/\w+)", head)
    for name in re.findall(rb"/(\w+)", filters[1]) if filters else []:
        if name not in (b"FlateDecode", b"Fl"):
            return b"" if b"/Image" in head else _unread(name)
        raw = zlib.decompressobj().decompress(raw)
    return raw


def _unread(name: bytes) -> bytes:
    raise PdfError(f"a stream filter that the built-in reader lacks: {name.decode()}; install pymupdf or pdfminer.six")


def _objects(data: bytes) -> dict[int, bytes]:
    if b"/Encrypt" in data:
        raise PdfError("an encrypted file; install pymupdf or pdfminer.six")
    found = {int(m[1]): m[3] for m in _OBJECT.finditer(data)}
    for body in list(found.values()):
        if b"/ObjStm" in body[:300]:
            inside, first = _stream(body), int(re.search(rb"/First\s+(\d+)", body)[1])
            places = list(map(int, inside[:first].split()))
            ends = [*places[3::2], len(inside) - first]
            for number, at, end in zip(places[::2], places[1::2], ends, strict=True):
                found.setdefault(number, inside[first + at : first + end])
    return found


def _string(token: bytes) -> bytes:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())

    def one(m: re.Match) -> bytes:
        x = m[1]
        return bytes([int(x, 8) & 255]) if x.isdigit() else _ESCAPES.get(x, b"" if x in b"\r\n" else x)

    return re.sub(rb"\\([0-7]{1,3}|\r\n|.)", one, token[1:-1], flags=re.S)


def _unicode_table(stream: bytes) -> tuple[int, dict[int, str]]:
    """Bytes a code, and code to text, of a ToUnicode table."""
    text = lambda x: bytes.fromhex(x.decode()).decode("utf-16-be", "replace")
    table: dict[int, str] = {}
    size = 1
    for part in re.findall(rb"begincodespacerange(.*?)endcodespacerange", stream, re.S):
        size = max([size, *(len(x) // 2 for x in re.findall(rb"<([0-9A-Fa-f]+)>", part))])
    for part in re.findall(rb"beginbfchar(.*?)endbfchar", stream, re.S):
        table |= {int(a, 16): text(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part)}
    for part in re.findall(rb"beginbfrange(.*?)endbfrange", stream, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(<[0-9A-Fa-f]+>|\[[^\]]*\])", part):
            lo, hi = int(a, 16), int(b, 16)
            if c[:1] == b"[":
                table |= {lo + i: text(x) for i, x in enumerate(re.findall(rb"<([0-9A-Fa-f]+)>", c))}
            else:
                base = text(c[1:-1])
                table |= {k: base[:-1] + chr(ord(base[-1]) + k - lo) for k in range(lo, min(hi, lo + 65535) + 1)}
    return size, table


def _decoder(objects: dict[int, bytes], font: bytes) -> Callable[[bytes], str]:
    m = re.search(rb"/ToUnicode\s+(\d+)", font)
    if m and int(m[1]) in objects:
        size, table = _unicode_table(_stream(objects[int(m[1])]) or b"")
        return lambda raw: "".join(table.get(int.from_bytes(raw[i : i + size], "big"), "") for i in range(0, len(raw), size))
    return lambda raw: raw.decode("cp1252", "replace")


def _named(objects: dict[int, bytes], body: bytes, key: bytes) -> bytes:
    """The value of a dictionary's key, followed once if it is a reference."""
    m = re.search(rb"/" + key + rb"\s*(\d+\s+\d+\s+R\b|<<.*|\[[^\]]*\]|/[^\s/]+|[-\d.]+)", body, re.S)
    if not m:
        return b""
    ref = _REF.match(m[1])
    return objects.get(int(ref[1]), b"") if ref else m[1]


def _pages(objects: dict[int, bytes], number: int, fonts: bytes, seen: set[int]) -> Iterator[tuple[bytes, bytes]]:
    """Body and fonts of each page below a node of the page tree; fonts come down from above."""
    body = objects.get(number, b"")
    if number in seen:
        return
    seen.add(number)
    resources = _named(objects, body, b"Resources")
    fonts = _named(objects, resources, b"Font") or fonts
    kids = _named(objects, body, b"Kids")
    if kids:
        for kid in _REF.findall(kids):
            yield from _pages(objects, int(kid), fonts, seen)
    else:
        yield body, fonts


def _page_text(content: bytes, decoders: dict[bytes, Callable[[bytes], str]]) -> str:
    out: list[str] = []
    stack: list[bytes] = []
    decode: Callable[[bytes], str] = lambda raw: raw.decode("cp1252", "replace")
    line = None
    in_array = False
    for token in _SHOW.findall(content):
        head = token[:1]
        if head in (b"(", b"/") or head == b"<" and token != b"<<" or head in b"+-.0123456789":
            if in_array and head in b"+-.0123456789":
                if float(token) < -GAP:
                    out.append(" ")
            elif in_array:
                out.append(decode(_string(token)))
            else:
                stack.append(token)
            continue
        if token == b"[":
            in_array = True
            continue
        if token == b"]":
            in_array = False
            continue
        if token == b"Tf" and len(stack) > 1:
            decode = decoders.get(stack[-2][1:], decode)
        elif token in (b"Tj", b"'", b'"') and stack and stack[-1][:1] in (b"(", b"<"):
            if token != b"Tj":
                out.append("\n")
            out.append(decode(_string(stack[-1])))
        elif token in (b"Td", b"TD") and len(stack) > 1:
            out.append("\n" if float(stack[-1]) else " ")
        elif token == b"T*" or token == b"ET":
            out.append("\n")
        elif token == b"Tm" and len(stack) > 5:
            out.append(" " if stack[-1] == line else "\n")
            line = stack[-1]
        stack = []
    return "\n".join(t for x in "".join(out).split("\n") if (t := " ".join(x.split())))


def simple_pdf_text(data: bytes) -> str:
    """The text by the built-in reader: a line for each shown line, a blank line between pages."""
    if not data.lstrip()[:5] == b"%PDF-":
        raise PdfError("no PDF file")
    objects = _objects(data)
    tops = [n for n, body in objects.items() if re.search(rb"/Type\s*/Catalog\b", body)]
    if not tops:
        raise PdfError("no page tree")
    root = _REF.search(re.search(rb"/Pages\s+(\d+\s+\d+\s+R)", objects[tops[-1]])[1])
    pages = []
    for body, fonts in _pages(objects, int(root[1]), b"", set()):
        decoders = {name: _decoder(objects, objects.get(int(ref), b"")) for name, ref in re.findall(rb"/([^\s/]+)\s+(\d+)\s+\d+\s+R", fonts)}
        m = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        content = b"\n".join(_stream(objects.get(int(r), b"")) or b"" for r in _REF.findall(m[1])) if m else b""
        if text := _page_text(content, decoders):
            pages.append(text)
    return "\n\n".join(pages)


def pdf_text(data: bytes, backend: str = "auto") -> str:
    """The text of a PDF file. `backend`: pymupdf, pdfminer, builtin, or auto for the first of these that is there."""
    if backend in ("auto", "pymupdf"):
        try:
            import fitz
        except ImportError:
            if backend == "pymupdf":
                raise
        else:
            with fitz.open(stream=data, filetype="pdf") as file:
                return "\n\n".join(t for page in file if (t := page.get_text().strip()))
    if backend in ("auto", "pdfminer"):
        try:
            from pdfminer.high_level import extract_text
        except ImportError:
            if backend == "pdfminer":
                raise
        else:
            import io

            return extract_text(io.BytesIO(data)).strip()
    return simple_pdf_text(data)
