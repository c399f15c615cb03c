"""Images: headers, digests, and bundles of them."""

import hashlib
import struct

import pytest

from lodestone.operators import image_bundles
from lodestone.sources import images

PNG = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 640, 480) + b"\x08\x02"
JPEG = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xff\xc4" + struct.pack(">H", 3) + b"x" + b"\xff\xc2" + struct.pack(">HBHH", 17, 8, 30, 50) + b"..."
WEBP = {"VP8X": b"VP8X" + bytes(8) + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"), "VP8L": b"VP8L" + bytes(5) + struct.pack("<I", 99 | 49 << 14), "VP8 ": b"VP8 " + bytes(10) + struct.pack("<HH", 100, 50)}


@pytest.mark.parametrize(("data", "want"), [
    (PNG, ("png", 640, 480)), (JPEG, ("jpeg", 50, 30)), (b"GIF89a" + struct.pack("<HH", 3, 4), ("gif", 3, 4)), (b"BM" + bytes(16) + struct.pack("<ii", 5, -6), ("bmp", 5, 6)),
    *[(b"RIFF" + bytes(4) + b"WEBP" + x, ("webp", 100, 50)) for x in WEBP.values()], (b"", (None, None, None)), (PNG[:20], (None, None, None)), (JPEG[:12], (None, None, None)), (b"plain text", (None, None, None)),
])
def test_headers(data, want):
    assert images.header(data) == want


def test_image_files_become_a_bundle(spark, tmp_path):
    (tmp_path / "b").mkdir()
    files = {"b/one.PNG": PNG, "b/two.jpg": JPEG, "b/cut.jpeg": JPEG[:9], "b/no.txt": b"x"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = images.read_images(spark, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[1]: r for r in found.collect()}
    assert {n: (r.kind, r.width, r.height) for n, r in rows.items()} == {"one.PNG": ("png", 640, 480), "two.jpg": ("jpeg", 50, 30), "cut.jpeg": (None, None, None)}
    assert rows["two.jpg"].sha256 == hashlib.sha256(JPEG).hexdigest() and rows["two.jpg"].length == len(JPEG)
    sha = {n: hashlib.sha256(d).hexdigest() for n, d in files.items()}
    given = spark.createDataFrame([("s", 1, "x/one.PNG", sha["b/one.PNG"], " read\nme "), ("s", 2, "x/two.jpg", sha["b/two.jpg"], None), ("t", 1, "y/a b.jpg", sha["b/two.jpg"], "")], "bundle string, ordinal int, path string, sha256 string, ocr_text string")
    placed = image_bundles.pages(given)
    made = {r.bundle: r for r in image_bundles.bundles(placed, "figure-image").collect()}
    assert made["s"].document == "\n".join(["<!-- source-page: 1 -->", "", "# Image page 1", "", "![Image page 1](images/page_001.png)", "", "<!-- ocr-derived: true; qa: review -->", "", "## OCR Text", "", "read\nme", "", "<!-- source-page: 2 -->", "", "# Image page 2", "", "![Image page 2](images/page_002.jpg)", "", "<!-- image-only-source: true; qa: review -->", "", image_bundles.UNAVAILABLE]) + "\n"
    assert made["s"].source_sha256 == hashlib.sha256((sha["b/one.PNG"] + sha["b/two.jpg"]).encode()).hexdigest() and made["s"].source_filename == "one-image-set"
    assert made["t"].source_sha256 == sha["b/two.jpg"] and made["t"].source_filename == "a b.jpg" and made["s"].status == "warn"
    assert [tuple(i) for i in made["s"].issues] == [("ocr-text-unavailable", 2), ("standalone-image-source-review-required", None)]
    assert made["s"].review_required == ["image-source-visual-review", "ocr-text-verification", "figure-internals-when-used-as-evidence"]
    assert [(r.section_id, r.start_line, r.end_line) for r in image_bundles.sections(placed).filter("bundle = 's'").orderBy("section_id").collect()] == [("page_001", 3, 11), ("page_002", 15, 21)]
    assert image_bundles.bundles(image_bundles.pages(given.limit(0))).count() == 0
