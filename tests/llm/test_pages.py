"""HTML extraction and WARC archives."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

import __spark_entry__ as contract
from propgraph.llm import html_extract, warc
from propgraph.llm.common import read
from tests.llm.helpers import clashing, sentence

PAGE = """<html><head><title>x</title><style>p{}</style></head><body><div id="cookie-notice">We use cookies.</div>
<header class="site-header"><h1>Site name</h1></header><div class="sidebar"><p>Some <i>links</i></p><ul><li><a>one</a><li><a>two</a></ul></div>
<article><h1>Title &amp; more</h1><p>In, of the <b>inanin</b>.  Thonst&nbsp;on.<p>Second para<br>line two.<blockquote>Quoted text.</blockquote></article>
<section class="comments"><h3>Comments</h3><p>Great article, thank you all for it.</p></section><form><p>Sign up</p></form>
<script>var t = "</p>";</script><footer>&copy; 2020</footer></body></html>"""
MAIN = "Title & more\nIn, of the inanin. Thonst on.\nSecond para line two.\nQuoted text."


@pytest.fixture(scope="module")
def model():
    pages = [PAGE] + [
        f"<nav><ul><li><a>{sentence(i, 1)}</a></li></ul></nav><article><h1>{sentence(i + 1, 5)}</h1><p>{sentence(i + 2, 40)}.</p>"
        f"<p>{sentence(i + 3, 30)}.</p></article><footer>{sentence(i + 4, 6)}</footer>"
        for i in range(0, 600, 6)
    ]
    return html_extract.fit(*html_extract.training_pages(pages), epochs=8)


def test_blocks():
    assert [t for _, t in html_extract.parse_blocks(PAGE)][5:9] == MAIN.split("\n")
    assert html_extract.parse_blocks(None) == html_extract.parse_blocks("") == html_extract.parse_blocks("<p> </p>") == []
    assert [t for _, t in html_extract.parse_blocks("a &am <b>b</p>c<div>d <p>e")] == ["a &am b", "c", "d", "e"]


def texts(html):
    return [t for _, t in html_extract.parse_blocks(html)]


def test_open_heads_and_closed_elements_hide_nothing():
    assert texts("<html><head><title>t</title><style>p{}</style><body><p>one</p></body></html>") == ["one"]
    assert texts("<head><meta charset=x><title>t</title><p>one<p>two") == ["one", "two"]
    assert texts("<head><title>t</title> plain <b>text</b></html>") == ["plain text"]
    assert texts("<head><noscript><img src=x></noscript><template><p>no</p></template><title>t</title></head><p>one") == ["one"]
    for closed in ("<svg width=1 />", "<iframe src='x'/>", "<svg><path d='x'/><g/></svg>", "<math/>"):
        assert texts(f"<div>before {closed} after</div><p>end</p>") == ["before after", "end"]
    assert texts("<div>before <svg><title>no</title><g/>no</svg> after</div>") == ["before", "after"]


def test_extract(spark, model):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", PAGE), (4, "u", "<p" + "x" * 1000), (5, "u", "<article>" + "<p>word and more.</p>" * 9000)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r for r in html_extract.extract(pages, model).collect()}
    assert got[1].text == got[None].text == MAIN
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert got[5].text.count("\n") == 8999
    assert html_extract.extract(pages.limit(0), model).count() == 0


def test_long_blocks_are_told_apart_by_their_words():
    path = (("body", ()), ("div", ()))
    legal = "we use cookies and partners to store consent choices settings privacy policy accept reject manage legitimate interest".split()

    def blocks(seed):
        choose = np.random.default_rng(seed)
        notice = " ".join(choose.choice(legal, 90)) + "."
        return [(path, notice), (path, sentence(seed, 90) + ".")], [0.0, 1.0]

    def page(seed):
        pair, labels = blocks(seed)
        order = [1, 0] if seed % 2 else [0, 1]
        return [html_extract.block_features(pair[i]) for i in order], np.array([labels[i] for i in order])

    learned = html_extract.fit(*map(list, zip(*(page(i) for i in range(200)), strict=True)), epochs=8)
    for seed in range(1000, 1020):
        features, labels = page(seed)
        assert (learned.label([features])[0] == (labels > 0)).all()


def test_long_sequences_are_read_in_pieces_alike(model, monkeypatch):
    page = [html_extract.block_features(b) for b in html_extract.parse_blocks(PAGE) * 5]
    whole = model.label([page])[0]
    monkeypatch.setattr(html_extract, "PIECE", 7)
    assert (model.label([page])[0] == whole).all()


def test_gradients_against_differences():
    model = html_extract.BlockModel.start(3)
    rng = np.random.default_rng(1)
    x, mask = rng.normal(0, 1, (5, 2, 2 * html_extract.DIM)), np.ones((5, 2))
    mask[3:, 1] = 0
    seed = rng.normal(0, 1, (5, 2, html_extract.HIDDEN))

    def loss():
        return float((model.run(0, x, mask)[0] * seed).sum())

    grads = html_extract._back_through(model.lstm[0], x, model.run(0, x, mask)[1], seed)
    for weight, grad in zip((x, *model.lstm[0]), grads, strict=True):
        for at in [tuple(rng.integers(0, n) for n in weight.shape) for _ in range(12)]:
            old, step = weight[at], 1e-5
            weight[at] = old + step
            up = loss()
            weight[at] = old - step
            down = loss()
            weight[at] = old
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-4


def test_main_text_query(spark, sf_dir):
    pages = {r.page_id: r.html for r in read(spark, sf_dir, "pages").collect()}
    rows = contract.queries()["op8_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)

    def by_markup(html):
        return "\n".join(t for path, t in html_extract.parse_blocks(html) if html_extract.markup_label(path))

    assert np.mean([r.text == by_markup(pages[r.page_id]) for r in rows]) > 0.98


def slow_records(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data, page_id)
        revisit = refers != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", refers if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = [(9, "u\r\nv", "é" * 60), (3, None, "é" * 60), (4, "u", None), (5, "u", ""), (6, "u", "x" * 99), (7, "u", "x" * 99), (8, "u", "y" * 3_000_000)]
    rows += [(None, "u", "é" * 60), (None, "u", "z" * 200), (3, None, "é" * 60)] + [(100 + i, "u", sentence(i % 50, 60)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    extra = pages.selectExpr("*", "'x' AS digest", "1 AS first_id", "2 AS n", "true AS revisit")
    got = warc.round_trip(extra, archive_bytes=20_000).collect()
    columns = "page_id payload_bytes payload_digest record_type refers_to".split()
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == slow_records(rows)
    texts = {(r[0], (r[2] or "").encode()) for r in rows}
    assert all((r.page_id, bytes(r.block)) in texts for r in got if r.record_type == "response")
    assert warc.round_trip(pages.limit(0)).count() == 0


def records(n=40):
    out = []
    for i in range(n):
        payload = f"<p>{sentence(i, 80)}</p>".encode()
        out.append(warc.make_record(i, "http://a/b", payload, hashlib.sha256(payload).hexdigest(), None, False))
    return out


def test_archive_layout():
    import zstandard

    made = records(300)
    archive = warc.write_archive(made)
    assert int.from_bytes(archive[:4], "little") == 0x184D2A5D
    size = int.from_bytes(archive[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompressobj().decompress(archive[8 : 8 + size]))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert reader.decompress(archive[8 + size :]) == made[0]  # one frame holds one record
    assert list(warc.read_archive(archive)) == made
    assert list(warc.read_archive(warc.write_archive(made[:1]))) == made[:1]  # too little to train a dictionary on
    assert list(warc.read_archive(warc.write_archive([]))) == []


def test_broken_archives_are_refused():
    archive = warc.write_archive(records(60))
    for broken in (archive[:-5], archive[:6], archive[:-200] + b"\0" * 200, archive + b"tail"):
        with pytest.raises(warc.WarcError):
            list(map(warc.checked, warc.read_archive(broken)))
    good = records(1)[0]
    for bad in (good[:-2], good.replace(b"WARC/1.1", b"WARC/0.9"), good.replace(b"WARC-Date", b"No-Date"), good.replace(b"<p>", b"<q>"), good + b"x"):
        with pytest.raises(warc.WarcError):
            warc.checked(bad)


def foreign(kind="response", block=b"", version=b"WARC/1.0", **more):
    headers = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:7b1f>", "WARC-Date": "2020-01-01T00:00:00Z", **more}
    lines = [version, *(f"{k.replace('_', '-')}: {v}".encode() for k, v in headers.items()), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_made_elsewhere():
    import base64

    body = b"<p>text</p>"
    message, http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + body, {"Content_Type": "application/http; msgtype=response"}
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    want = hashlib.sha256(body).hexdigest()
    for stated in ({}, {"WARC_Payload_Digest": sha1}, {"WARC_Payload_Digest": f"sha256:{want.upper()}"}, {"WARC_Payload_Digest": "blake3:00"}):
        assert warc.checked(foreign(block=message, **http, **stated)) == (None, "", message, len(body), want, "response", None)
    assert warc.checked(foreign(block=body, version=b"WARC/1.1"))[3:5] == (len(body), want)
    revisit = foreign("revisit", message[: -len(body)], WARC_Payload_Digest=sha1, WARC_Refers_To="<urn:uuid:1>", **http)
    assert warc.checked(revisit)[3:] == (None, sha1, "revisit", None)
    for kind in ("warcinfo", "request", "metadata", "resource", "conversion", "continuation"):
        assert warc.checked(foreign(kind, b"software: x")) is None
    for bad in (
        foreign(block=message, **http, WARC_Payload_Digest="sha1:AAAA"),
        foreign(block=body, X_Payload_Length="12"),
        foreign(block=body, X_Payload_Length="\u00b2"),
        foreign("revisit"),
        foreign("revisit", body, WARC_Refers_To="<urn:uuid:1>"),
        foreign("page"),
        foreign(block=body).replace(b"WARC-Date:", b"WARC-Date\xff"),
    ):
        with pytest.raises(warc.WarcError):
            warc.checked(bad)


def test_archives_made_elsewhere_are_read(spark, tmp_path):
    made = [foreign("warcinfo", b"software: x"), foreign(block=b"<p>one</p>"), foreign("request", b"GET /"), foreign(block=b"")]
    (tmp_path / "a.warc.zst").write_bytes(warc.write_archive(made))
    names = spark.createDataFrame([("a.warc.zst", None, None)], "name string, records long, bytes long")
    rows = warc.read_archives(spark, warc.as_uri(str(tmp_path)), names).collect()
    assert sorted((r.page_id, bytes(r.block), r.record_type) for r in rows) == [(None, b"", "response"), (None, b"<p>one</p>", "response")]
    wrong = names.selectExpr("name", "2L AS records", "bytes")
    with pytest.raises(Exception, match="4 records instead of 2"):
        warc.read_archives(spark, warc.as_uri(str(tmp_path)), wrong).collect()



def test_files_are_the_archives(spark, tmp_path):
    """What lies in the folder is the archive, byte for byte, without a further compression around it."""
    pages = spark.createDataFrame([(i, "u", sentence(i, 80)) for i in range(300)], "page_id long, url string, html string")
    folder = warc.as_uri(str(tmp_path / "out"))
    rows = warc.write_archives(pages.coalesce(1), folder).collect()
    found = {f.name: f.read_bytes() for f in (tmp_path / "out").iterdir() if f.suffix == ".zst"}
    assert {r.name: r.bytes for r in rows} == {name: len(data) for name, data in found.items()}
    assert all(int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC for data in found.values())
    assert sum(len(list(warc.read_archive(data))) for data in found.values()) == 300
