import gzip
import json
import zipfile
import zlib

import pytest

from lexiloom.sources.documents import doc_ids, of_language, read_crawl, read_epub, read_pdf, read_text
from lexiloom.sources.pdf import PdfError, pdf_text, simple_pdf_text


def make_epub(path, chapters):
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("META-INF/container.xml", '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/content.opf"/></rootfiles></container>')
        items = "".join(f'<item id="c{i}" href="text/c%20{i}.xhtml" media-type="application/xhtml+xml"/>' for i in range(len(chapters)))
        order = "".join(f'<itemref idref="c{i}"/>' for i in reversed(range(len(chapters))))
        book.writestr("OEBPS/content.opf", f'<package xmlns="http://www.idpf.org/2007/opf"><manifest>{items}<item id="css" href="s.css" media-type="text/css"/></manifest><spine>{order}</spine></package>')
        for i, c in enumerate(chapters):
            book.writestr(f"OEBPS/text/c {i}.xhtml", c)


def make_pdf(pages, deflate=True, to_unicode=None):
    objects, kids = {}, []
    n = 4
    for lines in pages:
        content = b"BT /F1 12 Tf 72 720 Td " + b" 0 -14 Td ".join(b"(" + x.encode("cp1252").replace(b"(", b"\\(").replace(b")", b"\\)") + b") Tj" for x in lines) + b" ET"
        raw = zlib.compress(content) if deflate else content
        objects[n] = b"<< /Length %d %s>>\nstream\n" % (len(raw), b"/Filter /FlateDecode " if deflate else b"") + raw + b"\nendstream"
        objects[n + 1] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % n
        kids.append(b"%d 0 R" % (n + 1))
        n += 2
    objects[1] = b"<< /Type /Catalog /Pages 2 0 R >>"
    objects[2] = b"<< /Type /Pages /Kids [" + b" ".join(kids) + b"] /Count %d /Resources << /Font << /F1 3 0 R >> >> >>" % len(pages)
    objects[3] = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica " + (b"/ToUnicode %d 0 R " % n if to_unicode else b"") + b">>"
    if to_unicode:
        objects[n] = b"<< /Length %d >>\nstream\n" % len(to_unicode) + to_unicode + b"\nendstream"
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, objects[k]) for k in sorted(objects)) + b"trailer << /Root 1 0 R >>\n%%EOF"


def test_text_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "x.txt").write_text("bir\niki")
    (tmp_path / "a" / "b" / "y.txt").write_text("üç")
    (tmp_path / "a" / "z.log").write_text("no")
    assert sorted(r["text"] for r in read_text(spark, str(tmp_path)).collect()) == ["bir\niki", "üç"]
    lines = read_text(spark, str(tmp_path), whole=False)
    assert sorted(r["text"] for r in lines.collect()) == ["bir", "iki", "üç"]
    ids = [r[0] for r in lines.select(doc_ids(lines)).collect()]
    assert len(set(ids)) == 3


def test_crawl_records(spark, tmp_path):
    for lang, text in (("tr", "merhaba"), ("en", "hello"), ("tr-validation", "selam")):
        with gzip.open(tmp_path / f"c4-{lang}.tfrecord-00000-of-00001.json.gz", "wt") as f:
            f.write(json.dumps({"text": text, "timestamp": "2020-01-01", "url": "http://x"}) + "\n")
    assert sorted(r["text"] for r in read_crawl(spark, str(tmp_path), "tr").collect()) == ["merhaba", "selam"]
    assert read_crawl(spark, str(tmp_path)).count() == 3


def test_language_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("tr", "a"), ("en", "b"), (None, "c")], "lang string, text string").write.parquet(str(tmp_path / "t"))
    df = of_language(spark.read.parquet(str(tmp_path / "t")), "tr")
    assert [r["text"] for r in df.collect()] == ["a"]
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,tr)]" in df._jdf.queryExecution().executedPlan().toString()


def test_epub(spark, tmp_path):
    make_epub(tmp_path / "book.epub", ["<html><head><title>t</title></head><body><p>second</p></body></html>", "<html><body><h1>First</h1><p>one &amp; two</p></body></html>"])
    (tmp_path / "bad.epub").write_bytes(b"no zip")
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in read_epub(spark, str(tmp_path), errors="null").collect()}
    assert got == {"book.epub": "First\none & two\n\nsecond", "bad.epub": None}
    with pytest.raises(Exception, match="zip"):
        read_epub(spark, str(tmp_path)).collect()


def test_pdf(spark, tmp_path):
    for deflate in (True, False):
        data = make_pdf([["Hello (all) of you", "café"], ["Page two"]], deflate)
        assert simple_pdf_text(data) == "Hello (all) of you\ncafé\n\nPage two"
    (tmp_path / "a.pdf").write_bytes(data)
    assert read_pdf(spark, str(tmp_path), backend="builtin").first()["text"].endswith("Page two")
    assert pdf_text(data) == simple_pdf_text(data) or pdf_text(data)


def test_pdf_codes_and_gaps():
    table = b"begincodespacerange <00> <FF> endcodespacerange 1 beginbfchar <41> <015F> endbfchar 1 beginbfrange <42> <43> <0069> endbfrange"
    assert simple_pdf_text(make_pdf([["ABC"]], to_unicode=table)) == "şij"
    data = make_pdf([["x"]], False).replace(b"(x) Tj", b"[(Wor) -20 (ld) -300 (here)] TJ")
    assert simple_pdf_text(data.replace(b"/Length", b"/Len")) == "World here"


@pytest.mark.parametrize("data", [b"", b"%PDF-1.4\n", b"no pdf", b"%PDF-1.4 /Encrypt"])
def test_pdf_that_cannot_be_read(data):
    with pytest.raises(PdfError):
        simple_pdf_text(data)
