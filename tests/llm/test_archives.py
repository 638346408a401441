"""Archives as files: what another reader finds in them, and what is lost or damaged."""

import gzip
import hashlib
import io
import zlib
from pathlib import Path

import pytest

from kinetra.llm import warc


@pytest.fixture
def archive(spark, tmp_path):
    rows = [(i, f"http://x/{i}", None if i == 3 else f"<p>{'page ' * (i % 7 * 50)}{i}</p>") for i in range(60)] + [(60, "http://x/60", "<p>7</p>")]
    folder = f"file://{tmp_path}/w"
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, shard_bytes=2000, roll_bytes=3000)
    return folder, tmp_path / "w", rows


def test_files_are_plain_archives(spark, archive):
    folder, place, rows = archive
    manifest = {r.name: r for r in spark.read.parquet(f"{folder}/_manifest").collect()}
    assert {p.name for p in place.glob("*.warc.gz")} == set(manifest) and len(manifest) > 3 and not (place / "_temporary").exists()
    payloads = {}
    for name, r in manifest.items():
        data = (place / name).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256)
        members, rest = 0, data
        while rest:  # member by member, each one whole record
            inflate = zlib.decompressobj(31)
            text = inflate.decompress(rest)
            assert inflate.eof and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            rest, members = inflate.unused_data, members + 1
            head, _, block = text.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            assert len(block) == int(fields["Content-Length"]) + 4
            if fields["WARC-Type"] == "response":
                payloads[fields["WARC-Target-URI"]] = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2].decode()
        assert members == r.records and gzip.open(io.BytesIO(data)).read().count(b"WARC/1.1\r\n") == members
    assert payloads == {url: html or "" for i, url, html in rows if i != 7}  # 7 is a revisit of 60
    assert warc.read_archive(spark, folder).count() == len(rows)


def damage(place: Path, how: str) -> None:
    path = max(place.glob("*.warc.gz"), key=lambda p: p.stat().st_size)
    data = path.read_bytes()
    if how == "cut":
        path.write_bytes(data[:-10])
    elif how == "member lost":
        inflate = zlib.decompressobj(31)
        inflate.decompress(data)
        path.write_bytes(inflate.unused_data)
    elif how == "other":
        path.write_bytes(gzip.compress(b"x") * 2)
    elif how == "emptied":
        path.write_bytes(b"")
    else:
        path.unlink()


@pytest.mark.parametrize("how", ["cut", "member lost", "other", "emptied", "missing"])
def test_damaged_archives_are_errors(spark, archive, how):
    folder, place, _ = archive
    damage(place, how)
    for crc in place.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="is not the file|No such file|does not exist|FileNotFound|damaged|not in list|unpack|WARC"):
        warc.read_archive(spark, folder).collect()


def test_a_lost_temporary_is_an_error(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    cut = warc.cut

    def losing(df, what="cut"):
        out = cut(df, what)
        if what == "written":
            out.count()
            for p in (tmp_path / "w/_temporary").iterdir():
                p.unlink()
        return out

    monkeypatch.setattr(warc, "cut", losing)
    with pytest.raises(Exception, match="bytes of"):
        warc.write_archive(pages, f"file://{tmp_path}/w")
