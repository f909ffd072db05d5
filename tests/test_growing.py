import io
import uuid
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException

from eventide.sources import growing, schemas, text


def read_on(spark, folder, rows):
    """Start the query of a folder again; the rows it has written so far."""
    writer = rows.writeStream.option("checkpointLocation", f"{folder}/checkpoint").format("parquet")
    writer.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def values(rows):
    return sorted(r.value for r in rows.collect())


def append(path, data):
    with open(path, "ab") as file:
        file.write(data)


def test_appended_lines_are_read_once_over_restarts(spark, folder, tmp_path):
    one, two = tmp_path / "a.log", tmp_path / "b.log"
    lines = lambda: growing.read_growing_lines(spark, str(tmp_path), "*.log", split_bytes=5)
    one.write_bytes(b"first\nsecond line\nthi")
    (tmp_path / "other.txt").write_text("no log\n")
    (tmp_path / "_hidden.log").write_text("hidden\n")
    assert values(read_on(spark, folder, lines())) == ["first", "second line"]
    append(one, b"rd")
    assert values(read_on(spark, folder, lines())) == ["first", "second line"]
    append(one, b"\r\n\n\nsame\nsame\nhalf")
    two.write_bytes("ü\n".encode() + b"\xff\n")
    expected = sorted(["first", "second line", "third", "", "", "same", "same", "ü", "�"])
    assert values(read_on(spark, folder, lines())) == expected
    assert values(read_on(spark, folder, lines())) == expected


def test_an_empty_folder_and_file_have_no_lines(spark, folder, tmp_path):
    assert values(read_on(spark, folder, growing.read_growing_lines(spark, str(tmp_path)))) == []
    (tmp_path / "empty").write_bytes(b"")
    assert values(read_on(spark, folder, growing.read_growing_lines(spark, str(tmp_path)))) == []


def test_a_file_that_is_gone_is_forgotten(spark, folder, tmp_path):
    (tmp_path / "a").write_text("old\n")
    read_on(spark, folder, growing.read_growing_lines(spark, str(tmp_path)))
    (tmp_path / "a").unlink()
    (tmp_path / "b").write_text("new\n")
    assert values(read_on(spark, folder, growing.read_growing_lines(spark, str(tmp_path)))) == ["new", "old"]


def test_a_shorter_file_fails(spark, folder, tmp_path):
    (tmp_path / "a").write_text("one\ntwo\n")
    read_on(spark, folder, growing.read_growing_lines(spark, str(tmp_path)))
    (tmp_path / "a").write_text("one\n")
    with pytest.raises(StreamingQueryException, match="became shorter"):
        read_on(spark, folder, growing.read_growing_lines(spark, str(tmp_path)))


def test_a_half_line_taken_goes_to_quarantine(spark, folder, tmp_path):
    (tmp_path / "a").write_text("1,2,3,pv,5\n4,5,6,b")
    lines = growing.read_growing_lines(spark, str(tmp_path), unfinished=growing.TAKE)
    parsed = read_on(spark, folder, text.parse_delimited(lines, schemas.USER_BEHAVIOR, mode=text.QUARANTINE))
    assert [r.item_id for r in text.good_rows(parsed).collect()] == [2]
    assert values(text.bad_lines(parsed)) == ["4,5,6,b"]


def test_one_file_and_wrong_options(spark, folder, tmp_path):
    (tmp_path / "a").write_text("one\n")
    (tmp_path / "b").write_text("two\n")
    rows = read_on(spark, folder, growing.read_growing_lines(spark, f"file:{tmp_path}/a"))
    assert values(rows) == ["one"]
    with pytest.raises(ValueError, match="unfinished"):
        growing.read_growing_lines(spark, str(tmp_path), unfinished="drop")


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("abü", max_size=9), max_size=12),
    st.booleans(),
    st.integers(1, 12),
    st.integers(1, 7),
    st.integers(0, 12),
)
def test_splits_hand_on_every_line_once(lines, whole, split_bytes, block, known):
    data = "\n".join(lines).encode() + (b"\n" if whole else b"")
    reader = growing.GrowingReader({"path": "", "splitbytes": str(split_bytes)})
    known = min(known, len(lines))
    first = min(len("".join(line + "\n" for line in lines[:known]).encode()), len(data))
    splits = reader.partitions({"f": first}, {"f": len(data)})
    found = []
    for split in splits:
        for part in growing.split_lines(io.BytesIO(data), split, block):
            found += part
    expected = data[first:].decode().split("\n")
    assert found == (expected[:-1] if expected[-1] == "" else expected)


@pytest.mark.parametrize("size", [growing.BLOCK_BYTES - 1, growing.BLOCK_BYTES, 3 * growing.BLOCK_BYTES + 5])
def test_the_last_line_feed_is_found_far_back(tmp_path, size):
    path = Path(tmp_path / uuid.uuid4().hex)
    path.write_bytes(b"ab\n" + b"x" * size)
    store, at = growing.opened(str(path))
    assert growing._after_last_line(store, at, size + 3) == 3
    path.write_bytes(b"x" * size)
    assert growing._after_last_line(store, at, size) == 0
