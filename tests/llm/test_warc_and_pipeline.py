"""WARC derivatives, the pipeline against plain versions of its stages, and every llm query."""

import gzip
import hashlib
import html
import re
from collections import Counter

import edge
import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from siltstone.llm import language_id, queries, warc

RESPONSES = "record_id string, target_uri string, date string, headers string, payload string"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    assert name in entry.queries()
    if name in queries.ORACLES:
        assert oracle.compare(spark, oracle.connect(small), queries.QUERIES[name], queries.ORACLES[name], small) is None
    else:
        table = "embeddings" if "neighbours" in name else "documents"
        n = spark.read.parquet(f"{small}/{table}.parquet").count()
        assert len(queries.QUERIES[name](spark, small).collect()) == (n if table == "documents" else 20 * len(range(0, n, 20)))


def test_derived_records_refer_to_their_response(spark):
    page = '<html><head><title>T</title></head><body><p>One &amp;lt; two</p><script>x</script><a href="/u">L</a><br>three</body></html>'
    rows = [
        ("<urn:a>", "http://a/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX: 1", page),
        ("<urn:b>", None, None, None, None),
        ("<urn:c>", "http://c/", None, "HTTP/1.1 204", ""),
        (None, "http://d/", None, "", "plain <b"),
        ("<urn:a>", "http://a/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX: 1", page),
    ]
    df = spark.createDataFrame(rows, RESPONSES).selectExpr("*", "'extra' AS block", "'extra' AS t", "7 AS page_id")
    out = warc.derive(df).collect()
    assert len(out) == 10 and out[0].page_id == 7 and out[0].t == "extra"
    first = [r for r in out if r.refers_to == "<urn:a>"]
    assert len({r.record_id for r in first}) == 2 and len(first) == 4
    meta = next(r for r in first if r.record_type == "metadata")
    assert meta.block.split("\r\n") == ["http-header: HTTP/1.1 200 OK", "http-header: X: 1", "outlink: /u"]
    text = next(r for r in first if r.record_type == "conversion")
    assert text.block == "One &lt; two\nL\nthree"
    for r in out:
        body = r.block.encode()
        assert r.content_length == len(body) and r.block_digest == "sha256:" + hashlib.sha256(body).hexdigest()
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.record_id)
    assert meta.payload_digest == "sha256:" + hashlib.sha256(page.encode()).hexdigest()
    assert warc.derive(spark.createDataFrame([], RESPONSES)).count() == 0


def test_very_long_page(spark):
    page = "<p>" + "word < " * 200_000 + "<script>" + "y" * 500_000 + "</script>" + "<!--" * 10_000
    df = spark.createDataFrame([("<urn:a>", "u", "d", "h", page)], RESPONSES)
    (row,) = warc.derive(df).where("record_type = 'conversion'").collect()
    assert row.block.startswith("word < word") and "yyy" not in row.block


def test_written_records_read_back(spark, small, tmp_path):
    derived = warc.derive(warc.responses(spark.read.parquet(f"{small}/pages.parquet")))
    warc.write_warc(derived, str(tmp_path / "out"))
    blocks = {r.record_id: (r.record_type, r.block) for r in derived.collect()}
    found = {}
    for path in (tmp_path / "out").glob("*.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            found[fields["WARC-Record-ID"]] = (fields["WARC-Type"], rest[:n].decode())
            data = rest[n + 4 :]
    assert found == blocks


def test_text_agrees_with_an_unescaper(spark):
    page = "a &lt;b&gt; &quot;c&quot; &amp;amp; &#39;d&#39; &copy; &middot;"
    df = spark.createDataFrame([("i", "u", "d", "h", page)], RESPONSES)
    (row,) = warc.derive(df).where("record_type = 'conversion'").collect()
    assert row.block == html.unescape(page)


def test_links_and_references_of_ordinary_pages(spark):
    page = (
        "<p>caf&eacute; &#233;&#xE9; &mdash; &amp;lt; &nosuch; &#0; &#xD800; &#9999999; a & b &lt</p>"
        "<!-- <a href='gone'>x</a> --><script>'<a href=\"gone\">'</script>"
        "<a class=b href='/one'>1</a><A HREF=/two>2</A><a href = \"/thr'ee\" id=x>3</a><a data-href='no' name=z>4</a><a href='/one'>5</a>"
    )
    df = spark.createDataFrame([("i", "u", "d", "h", page)], RESPONSES)
    rows = {r.record_type: r.block for r in warc.derive(df).collect()}
    assert rows["metadata"].split("\r\n") == ["http-header: h", "outlink: /one", "outlink: /two", "outlink: /thr'ee", "outlink: /one"]
    assert rows["conversion"] == "café éé — &lt; &nosuch; &#0; &#xD800; &#9999999; a & b &lt\n12345"


def test_columns_that_clash(spark):
    df = spark.createDataFrame([("i", "u", "d", "h", "<p>x</p>")], RESPONSES)
    names = [*edge.CLASHES, "__type", "__block", "kind", "seen", "digest", "Record_ID", "PAYLOAD", "Refers_To", "c0", "a.b"]
    out = warc.derive(df.selectExpr("*", *(f"'extra' AS `{n}`" for n in names)))
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    plain = warc.derive(df)
    rows = out.collect()
    assert [tuple(r[c] for c in plain.columns) for r in rows] == [tuple(r) for r in plain.collect()]
    assert all(r["__type"] == r["kind"] == r["a.b"] == "extra" for r in rows)


def test_pipeline_stages(spark, tmp_path):
    rows = edge.documents()
    path = str(tmp_path / "documents.parquet")
    edge.frame(spark, rows).write.parquet(path)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "BPE encoding and decoding",
    ]
    docs = edge.frame(spark, rows)
    before = docs.columns
    for k, (name, function) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = corpus_pipeline.stage(function(spark, docs, str(tmp_path)), f"test-{k}")
        assert out.columns == before and out.schema.simpleString() == docs.schema.simpleString()
        was, now = [r.text for r in docs.collect()], [r.text for r in out.collect()]
        if name == "language ID":
            scores = {r.text: r.score for r in language_id.identify(docs).join(docs, "doc_id").select("text", "score").collect()}
            for text in {t for t in was if t and any(c.isalpha() for c in t)}:
                runs = Counter(language_id.grams(text).tolist())
                alike = sum(runs.values()) ** 2 / sum(c * c for c in runs.values())
                # Of 2048 dimensions, 4 standard errors; runs of a language are taken to be 65,536.
                room = scores[text] + 4 / 2048**0.5 - (alike / (alike + 65_536)) ** 0.5
                assert abs(room) < 0.01 or (text in now) == (room > 0), text[:60]
            assert {t for t in was if len(edge.words(t)) > 50} <= set(now) and all(any(c.isalpha() for c in t) for t in now)
        if name == "n-gram Jaccard join":
            sets = [edge.gram_set(t) for t in now]
            for i in range(len(sets)):
                for j in range(i):
                    assert len(sets[i] & sets[j]) < 0.8 * len(sets[i] | sets[j])
            assert all(any(len(s & edge.gram_set(t)) >= 0.8 * len(s | edge.gram_set(t)) for s in sets) for t in was)
        if name == "suffix-array dedup":
            masks = edge.repeated_bytes([t.encode() for t in was], 250)
            left = [b"".join(p for p in re.split(b"\xff+", bytes(b if not m else 255 for b, m in zip(t.encode(), mask, strict=True)))) for t, mask in zip(was, masks, strict=True)]
            assert sorted(t.encode() for t in now) == sorted(x.decode("utf-8", "ignore").encode() for x in left)
            assert all(r.n_chars == len(r.text) for r in out.collect())
        if name == "mixing sources":
            assert set(now) <= set(was) and max(now.count(t) for t in set(now)) <= 3
        docs = out
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id or -1 for r in final.collect()) == sorted(r.doc_id or -1 for r in docs.collect())
    edge.frame(spark, []).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


