import zipfile

from pyspark.sql import functions as F

from trolley.operators import images
from trolley.plans.image_vectors import run_image_vectors
from trolley.sources import archives
from trolley.sources.archives import list_members, read_archives


def pack(folder):
    with zipfile.ZipFile(folder / "one.zip", "w") as archive:
        archive.writestr("a/b/0001.jpg", b"abc")
        archive.writestr("c/0001.jpg", b"later")
        archive.writestr("0002.jpg", b"")
        archive.writestr("../x.jpg", b"bad")
        archive.writestr("notes.txt", b"no")
    with zipfile.ZipFile(folder / "two.zip", "w") as archive:
        for i in range(50):
            archive.writestr(f"{i + 100:04d}.jpg", bytes([i + 1]) * 10)


def embedder():
    def embed(batch):
        return [None if not data else [float(len(data)), float(data[0])] for data in batch]

    return embed


def test_members_are_filtered_and_flattened(spark, tmp_path):
    pack(tmp_path)
    members = list_members(spark, str(tmp_path))
    assert members.count() == 52
    contents = {(r.archive, r.member): bytes(r.content) for r in read_archives(spark, str(tmp_path)).collect()}
    assert contents[("one.zip", "0001.jpg")] == b"later"
    assert contents[("two.zip", "0107.jpg")] == bytes([8]) * 10
    assert list_members(spark, str(tmp_path), 3).count() == 5
    first = read_archives(spark, str(tmp_path), 3, range_bytes=300).collect()
    assert sorted(r.member for r in first) == ["0001.jpg", "0002.jpg", "0100.jpg", "0101.jpg", "0102.jpg"]


def test_job_skips_broken_images_and_batches(spark, tmp_path):
    pack(tmp_path)
    run_image_vectors(spark, str(tmp_path), str(tmp_path / "out"), embedder, batch=4)
    table = spark.read.parquet(str(tmp_path / "out/embeddings"))
    assert table.count() == 51
    row = table.where("article_id = '0001'").first()
    assert abs(sum(x * x for x in row.image_embedding) - 1) < 1e-6

    def failing():
        def embed(batch):
            raise RuntimeError("device")

        return embed

    lost = images.embed_images(read_archives(spark, str(tmp_path)), failing)
    report = {r.archive: (r.embedded, r.failed) for r in images.embedding_report(lost).collect()}
    assert report == {"one.zip": (0, 2), "two.zip": (0, 50)}


def test_one_failing_image_costs_one_image(spark):
    frame = spark.createDataFrame([("a.zip", f"{i}.jpg", bytes([i])) for i in range(40)], "archive string, member string, content binary").coalesce(1)

    def picky():
        def embed(batch):
            if any(content == bytes([7]) for content in batch):
                raise ValueError("broken")
            return [[1.0, 2.0]] * (len(batch) - (len(batch) == 16 and batch[0] == bytes([16])))

        return embed

    rows = images.embed_images(frame, picky, batch=16).collect()
    lost = [(r.member, r.error) for r in rows if r.raw_vector is None]
    assert lost == [("7.jpg", "ValueError: broken")] and len(rows) == 40


def test_one_archive_is_read_by_several_tasks(spark, tmp_path):
    pack(tmp_path)
    read = read_archives(spark, str(tmp_path), range_bytes=200).where("archive = 'two.zip'")
    assert read.select(F.spark_partition_id().alias("p")).distinct().count() > 2
    rows = read.collect()
    assert len(rows) == len({r.member for r in rows}) == 50


def test_archives_are_opened_once_for_each_range(spark, tmp_path):
    pack(tmp_path)
    sizes = {p.name: p.stat().st_size for p in tmp_path.glob("*.zip")}
    ranges = archives.archive_ranges(spark, str(tmp_path), 1000).collect()
    assert len(ranges) <= len(sizes) + sum(sizes.values()) // 1000
    for name, size in sizes.items():
        own = sorted((r.start, r.stop) for r in ranges if r.path.endswith(name))
        assert own[0][0] == 0 and own[-1][1] == size
        assert all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))


def test_broken_archives_and_members_are_rows(spark, tmp_path):
    pack(tmp_path)
    whole = (tmp_path / "two.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "empty.zip").write_bytes(b"PK")
    place = whole.index(bytes([3]) * 10)
    (tmp_path / "member.zip").write_bytes(whole[:place] + b"x" + whole[place + 1 :])
    listed = {r.archive: r.error for r in list_members(spark, str(tmp_path)).where("error is not null").collect()}
    assert listed.keys() == {"cut.zip", "empty.zip"} and "BadZipFile" in listed["cut.zip"]
    read = read_archives(spark, str(tmp_path), range_bytes=500)
    lost = {(r.archive, r.member) for r in read.where("error is not null").collect()}
    assert lost == {("cut.zip", None), ("empty.zip", None), ("member.zip", "0102.jpg")}
    run_image_vectors(spark, str(tmp_path), str(tmp_path / "out"), embedder)
    report = {r.archive: (r.embedded, r.failed) for r in images.embedding_report(images.embed_images(read, embedder)).collect()}
    assert report == {"one.zip": (1, 1), "two.zip": (50, 0), "member.zip": (49, 1), "cut.zip": (0, 1), "empty.zip": (0, 1)}
    assert spark.read.parquet(str(tmp_path / "out/embeddings")).count() == 100


def test_only_one_batch_of_images_is_held_as_python_objects(spark):
    size, count = 100_000, 200
    frame = spark.range(count).coalesce(1).select(
        F.lit("a.zip").alias("archive"),
        F.concat("id", F.lit(".jpg")).alias("member"),
        F.rpad(F.col("id").cast("string"), size, " x").cast("binary").alias("content"),
    )

    def counting():
        import sys
        import tracemalloc

        tracemalloc.start()

        def embed(batch):
            alike = [t for t in tracemalloc.take_snapshot().traces if t.size == sys.getsizeof(batch[0])]
            return [[float(len(alike))]] * len(batch)

        return embed

    held = images.embed_images(frame, counting, batch=20).agg(F.max(F.col("raw_vector")[0])).first()[0]
    assert held <= 2 * 20
