"""The fixity audit against a plain comparison of two archives."""

from __future__ import annotations

import hashlib

from cases import empty

from millrace.llm import fixity

SCHEMA = "page_id long, url string, html string, archive long, node string, offset long, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 1, "d") for r in rows], SCHEMA)


def body(page_id, url, html):
    target = "" if url is None else f"WARC-Target-URI: {url}\r\n"
    data = html or ""
    return (
        f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{page_id}>\r\n{target}"
        f"Content-Type: text/html\r\nContent-Length: {len(data.encode())}\r\n\r\n{data}\r\n\r\n"
    ).encode()


def plain(a, b):
    def leaves(rows):
        out, at = {}, {}
        for r in sorted(rows, key=lambda r: (r[0], hashlib.sha256(body(*r)).hexdigest())):
            archive, data = r[0] // fixity.ARCHIVE_IDS, body(*r)
            nth = sum(k[0] == r[0] for k in out) + 1
            out[r[0], nth] = (at.get(archive, 0), hashlib.sha256(data).hexdigest())
            at[archive] = at.get(archive, 0) + len(data)
        return out

    one, two, found = leaves(a), leaves(b), {}
    for k in {*one, *two}:
        x, y = one.get(k), two.get(k)
        if x != y:
            verdict = "missing" if y is None else "extra" if x is None else "corrupt" if x[1] != y[1] else "moved"
            found[k] = (verdict, x and x[0], y and y[0])
    return found


def check(spark, a, b):
    got = fixity.audit(pages(spark, a), pages(spark, b)).collect()
    assert {(r.page_id, r.nth): (r.verdict, r.offset, r.replica_offset) for r in got} == plain(a, b)
    assert len(got) == len(plain(a, b))


def rows(n=300, step=37):
    return [(i * step, f"http://h{i % 7}/{i}", "<p>" + "é" * (i % 50) + "</p>" * (i % 9)) for i in range(n)]


def test_equal_replicas_have_no_findings(spark):
    check(spark, rows(), rows()[::-1])


def test_all_kinds_of_damage(spark):
    good = rows()
    bad = [r if i != 5 else (*r[:2], r[2][:-1] + "X") for i, r in enumerate(good)]
    del bad[40]
    bad[100] = (*bad[100][:2], bad[100][2] + "longer")
    bad.append((37 * 20 + 1, "http://new", "new"))
    check(spark, good, bad)


def test_only_damaged_archives_are_read(spark):
    good = rows(200, 1000)
    bad = [r if i != 150 else (*r[:2], "changed") for i, r in enumerate(good)]
    found = fixity.audit(pages(spark, good), pages(spark, bad)).collect()
    assert [(r.archive, r.page_id, r.verdict) for r in found] == [(150, 150_000, "corrupt")]


def test_repeated_null_and_long_records(spark):
    good = [(1, "u", "x"), (1, "u", "x"), (1, "u", "y"), (2, None, None), (3, "u", ""), (4, "u", "z" * 600_000), (5, "u", "q")]
    bad = [(1, "u", "x"), (1, "u", "y"), (2, None, ""), (3, None, ""), (4, "u", "z" * 599_999 + "y"), (5, "u", "q")]
    check(spark, good, bad)


def test_rows_without_an_id(spark):
    good = pages(spark, [(None, "u", "a"), (None, None, None), (None, "u", "a")])
    assert fixity.audit(good, good).collect() == []
    found = fixity.audit(good, pages(spark, [(None, "u", "a"), (None, None, None)])).collect()
    assert [(r.page_id, r.verdict) for r in found] == [(None, "missing")]


def test_empty_replicas(spark):
    none = pages(spark, [])
    assert fixity.audit(none, none).collect() == []
    assert {r.verdict for r in fixity.audit(none, pages(spark, rows(5))).collect()} == {"extra"}
    assert {r.verdict for r in fixity.audit(pages(spark, rows(5)), none).collect()} == {"missing"}
    assert empty(spark).count() == 0


def test_root_covers_offsets(spark):
    """Two records that change places in the same bytes differ at the root."""
    tree = fixity.Tree(pages(spark, rows(20)))
    other = fixity.Tree(pages(spark, [(r[0], r[1], r[2] + (" " if r[0] == 0 else "")) for r in rows(20)]))
    assert tree.groups[-1].collect() != other.groups[-1].collect()
    assert tree.groups[-1].count() == 1
