import os
import zipfile

from tabulon.sources.archives import expand_archives, nth_lines
from tabulon.sources.csv import read_csv_text

from core_helpers import local_dir


def make(d, name, members):
    with zipfile.ZipFile(os.path.join(d, name), "w") as zf:
        for m, text in members:
            zf.writestr(m, text)


def test_member_rules(spark, scratch):
    src = scratch + "/zips"
    d = local_dir(src)
    make(d, "one.zip", [("one.csv", "a,b\n1,2\n3,4\n")])
    make(d, "two.zip", [("x.csv", "a\n1\n"), ("y.csv", "a\n2\n")])
    make(d, "none.zip", [])
    make(d, "hidden.zip", [("h.csv", "a,b\n5,6\n"), ("__MACOSX/._h.csv", "junk"), (".DS_Store", "x")])
    out = scratch + "/out"
    report = {r.archive: (r.n_members, r.status) for r in expand_archives(spark, src, out).collect()}
    assert report == {"one.zip": (1, "extracted"), "two.zip": (2, "skipped"),
                      "none.zip": (0, "rejected"), "hidden.zip": (1, "extracted")}
    rows = sorted(tuple(r) for r in read_csv_text(spark, out).collect())
    assert rows == [("1", "2"), ("3", "4"), ("5", "6")]


def test_nth_line_brute_force(spark, scratch):
    src = scratch + "/zips"
    d = local_dir(src)
    texts = {f"z{i}.zip": "".join(f"line {i}-{j}\r\n" if j % 2 else f"line {i}-{j}\n" for j in range(i + 3))
             for i in range(4)}
    for name, text in texts.items():
        make(d, name, [("m.txt", text)])
    for n in (0, 2, 5):
        got = {r.archive: r.line for r in nth_lines(spark, src, n, "*.zip").collect()}
        want = {name: (text.splitlines()[n] if n < len(text.splitlines()) else None)
                for name, text in texts.items()}
        assert got == want


def test_unreadable_archive_does_not_stop_the_others(spark, scratch):
    import zipfile

    d = local_dir(scratch)
    os.makedirs(f"{d}/y1")
    with zipfile.ZipFile(f"{d}/y1/good.zip", "w") as zf:
        zf.writestr("a.csv", "X\n1\n")
    with open(f"{d}/y1/cut.zip", "wb") as fh:
        fh.write(b"PK\x03\x04 cut short")
    with zipfile.ZipFile(f"{d}/y1/crc.zip", "w") as zf:
        zf.writestr("a.csv", "X" * 1000)
    raw = bytearray(open(f"{d}/y1/crc.zip", "rb").read())
    raw[100] ^= 0xFF
    with open(f"{d}/y1/crc.zip", "wb") as fh:
        fh.write(raw)
    report = {r.archive: r.status for r in expand_archives(spark, scratch, scratch + "-out").collect()}
    assert report == {"y1/good.zip": "extracted", "y1/cut.zip": "corrupt", "y1/crc.zip": "corrupt"}
    lines = {r.archive: (r.status, r.line) for r in nth_lines(spark, scratch, 1).collect()}
    assert lines["y1/good.zip"] == ("extracted", "1") and lines["y1/cut.zip"] == ("corrupt", None)
