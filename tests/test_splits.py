"""The answer must not depend on how files are cut: sections, splits, byte ranges, any split size."""

import random

import pytest
from conftest import MINI, REDECLARED

from strataframe import Delivery, build_section_index, read_group, read_group_indexed
from strataframe.sources import byte_ranges, section_index

GROUPS = ("PROJ", "LOCA", "SAMP")


def random_delivery(seed: int) -> bytes:
    """Sections in random order, redeclared groups, odd cells, both line endings."""
    rng = random.Random(seed)
    newline = rng.choice(["\n", "\r\n"])
    out = []
    for _ in range(rng.randint(1, 25)):
        group = rng.choice(GROUPS)
        headings = [f"{group}_ID", f"{group}_A", f"{group}_B"]
        rng.shuffle(headings)
        out += [f'"GROUP","{group}"', ",".join(f'"{h}"' for h in ["HEADING", *headings])]
        if rng.random() < 0.8:
            out.append('"UNIT","","m",""')
        if rng.random() < 0.8:
            out.append('"TYPE","X","X","X"')
        for _ in range(rng.choice([0, 1, 2, 30])):
            cells = [rng.choice(["", "a,b", 'say ""no""', "é" * rng.randint(1, 9), "x" * rng.randint(1, 60)]) for _ in range(rng.randint(1, 4))]
            out.append(",".join(f'"{c}"' for c in ["DATA", *cells]))
        out += [""] * rng.randint(0, 2)
    return (newline.join(out) + rng.choice(["", newline])).encode()


def expected(raw: bytes, group: str) -> list[tuple]:
    """A plain reading of the format, kept independent of the library."""
    rows, current, headings = [], None, []
    for line in raw.decode().replace("\r\n", "\n").split("\n"):
        if not line:
            continue
        cells = [c.replace('""', '"') for c in line[1:-1].split('","')]
        # The generator writes no cell that contains the separator `","`.
        if cells[0] == "GROUP":
            current, headings = cells[1], []
        elif cells[0] == "HEADING":
            headings = cells[1:]
        elif cells[0] == "DATA" and current == group:
            found = dict(zip(headings, cells[1:]))
            rows.append(tuple(found.get(f"{group}_{c}") or None for c in ("ID", "A", "B")))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("deliveries")
    for seed in range(5):
        (path / f"d{seed}.ags").write_bytes(random_delivery(seed))
    return path


def rows_of(df, group):
    names = [f"{group}_{c}" for c in ("ID", "A", "B")]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("split", [151, 4096])
@pytest.mark.parametrize("limit", [0, 1500, 10**9])
def test_any_split_and_any_reader(spark, folder, tiny_splits, split, limit):
    tiny_splits(split)
    delivery = Delivery.from_files(spark, str(folder), section_file_bytes=limit)
    for group in GROUPS[1:]:
        want = sorted((r for f in folder.iterdir() for r in expected(f.read_bytes(), group)), key=repr)
        assert rows_of(delivery.group(group, allow_custom=True), group) == want
    counted = {r["group"]: r.n_rows for r in delivery.row_counts().collect()}
    assert counted == {g: sum(len(expected(f.read_bytes(), g)) for f in folder.iterdir()) for g in counted}


@pytest.mark.parametrize("split", [151, 10**8])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_index_spans_are_exact(spark, folder, tiny_splits, split, limit):
    tiny_splits(split)
    rows = build_section_index(spark, str(folder), section_file_bytes=limit).collect()
    for file in folder.iterdir():
        raw = file.read_bytes()
        spans = sorted((r.start, r.end, r["group"], r.n_data) for r in rows if r.path.endswith(file.name))
        starts = [i for i in range(len(raw)) if raw.startswith(b'"GROUP",', i)]
        assert [s[0] for s in spans] == starts
        assert [s[1] for s in spans] == [*starts[1:], len(raw)]
        for start, end, group, n_data in spans:
            assert raw[start:end].startswith(f'"GROUP","{group}"'.encode())
            assert raw[start:end].count(b'\n"DATA"') == n_data


@pytest.mark.parametrize("chunk", [37, 10**7])
def test_sliced_read_in_chunks(spark, folder, monkeypatch, tmp_path, chunk):
    monkeypatch.setattr(byte_ranges, "CHUNK_BYTES", chunk)
    build_section_index(spark, str(folder)).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    for group in GROUPS[1:]:
        sliced = read_group_indexed(spark, str(folder), group, index, allow_custom=True)
        plain = read_group(spark, str(folder), group, allow_custom=True)
        assert sorted(map(tuple, sliced.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_redeclared_group_is_not_sliced(spark, redeclared):
    index = build_section_index(spark, redeclared).persist()
    assert {(r["group"], r.span_no) for r in index.collect()} == {("LOCA", 1), ("LOCA", 2), ("PROJ", 1)}
    listing = section_index.file_listing(spark, [redeclared])
    spans, whole = section_index.split_by_freshness(listing, index, "LOCA")
    assert (spans.count(), whole.count()) == (0, 1)
    spans, whole = section_index.split_by_freshness(listing, index, "PROJ")
    assert (spans.count(), whole.count()) == (1, 0)
    # An indexed file without the group needs no reading at all.
    spans, whole = section_index.split_by_freshness(listing, index, "SAMP")
    assert (spans.count(), whole.count()) == (0, 0)
    assert sorted(r.LOCA_ID for r in read_group_indexed(spark, redeclared, "LOCA", index).collect()) == ["BH01", "BH02"]


def test_stale_index_costs_no_rows(spark, tmp_path):
    file = tmp_path / "site.ags"
    file.write_text(MINI)
    build_section_index(spark, str(file)).write.parquet(str(tmp_path / "index"))
    file.write_text(MINI.replace('"DATA","BH02","TP","98.00"\n', '"DATA","BH02","TP","98.00"\n"DATA","BH03","TP","97.00"\n'))
    index = spark.read.parquet(str(tmp_path / "index"))
    listing = section_index.file_listing(spark, [str(file)])
    assert section_index.split_by_freshness(listing, index, "LOCA")[1].count() == 1
    assert read_group_indexed(spark, str(file), "LOCA", index).count() == 3


def test_redeclared_rows(spark, redeclared):
    for limit in (0, 10**9):
        delivery = Delivery.from_files(spark, redeclared, section_file_bytes=limit)
        assert sorted(r.LOCA_ID for r in delivery.group("LOCA").collect()) == ["BH01", "BH02"]
        assert [(r["group"], r.n_rows) for r in delivery.groups().collect()] == [("LOCA", 2), ("PROJ", 1)]


def test_compressed_file(spark, tmp_path):
    import gzip

    (tmp_path / "site.ags.gz").write_bytes(gzip.compress(REDECLARED.encode()))
    assert read_group(spark, str(tmp_path), "LOCA").count() == 2


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "bom.ags").write_bytes(b"\xef\xbb\xbf" + MINI.encode())
    for limit in (0, 10**9):
        delivery = Delivery.from_files(spark, str(tmp_path), section_file_bytes=limit)
        assert delivery.group("PROJ").count() == 1
        index = build_section_index(spark, str(tmp_path), section_file_bytes=limit)
        raw = (tmp_path / "bom.ags").read_bytes()
        spans = index.collect()
        assert min(r.start for r in spans) == 3 and max(r.end for r in spans) == len(raw)
        assert all(raw[r.start:].startswith(b'"GROUP"') for r in spans)


def test_section_scan_needs_no_shuffle_and_no_python(spark, mini):
    delivery = Delivery.from_files(spark, mini)
    plan = delivery.group("LOCA")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "InArrow" not in plan
