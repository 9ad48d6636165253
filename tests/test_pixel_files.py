"""Image files written from rows: what is read back, and what is refused."""

from __future__ import annotations

import pytest

from venuelake.sources import images, pixel_files

SCHEMA = "name string, width int, height int, channels int, pixels binary"


def test_round_trip_and_rejects(spark, tmp_path):
    folder = str(tmp_path / "images")
    grey, colour = bytes([0, 7, 255, 9, 128, 3]), bytes(range(12))
    rows = spark.createDataFrame([("a", 3, 2, 1, bytearray(grey)), ("b", 2, 2, 3, bytearray(colour))], SCHEMA)
    pixel_files.write_images(rows, folder)
    pixel_files.write_images(rows.where("name = 'a'"), folder)
    (tmp_path / "images" / "broken.png").write_bytes(b"no image")
    found = {r.origin.rsplit("/", 1)[1]: r for r in images.image_vectors(spark, folder).collect()}
    assert found.keys() == {"a.png", "b.png"}
    assert (found["a.png"].width, found["a.png"].height, found["a.png"].nChannels) == (3, 2, 1)
    assert bytes(found["a.png"].pixels) == grey
    # Colours are read as blue, green, red.
    assert bytes(found["b.png"].pixels) == b"".join(colour[k : k + 3][::-1] for k in range(0, 12, 3))
    assert [r.origin.rsplit("/", 1)[1] for r in images.unreadable_images(spark, folder).collect()] == ["broken.png"]
    assert images.image_headers(spark, folder).count() == 2


@pytest.mark.parametrize("row", [("a", 3, 2, 1, bytearray(5)), ("a", 1, 1, 2, bytearray(2)), ("a", 1, 1, 1, None), ("a", 0, 1, 1, bytearray())])
def test_rows_that_do_not_fit_fail(spark, tmp_path, row):
    with pytest.raises(Exception, match="do not fit"):
        pixel_files.write_images(spark.createDataFrame([row], SCHEMA), str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").glob("*.png"))
