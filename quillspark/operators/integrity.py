"""Comparison of builds and manifests, archive listings, and fits of measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import member_path, unsafe_member

#: Layout names and thresholds by which uploads for image tasks are told (fixed values).
IMAGE_DIRS = ["images", "image", "img", "imgs", "jpegimages", "pics"]
MASK_DIRS = ["masks", "mask", "labels_masks", "segmentation", "segmentations", "segmentationclass", "gt", "ground_truth", "annotations_masks"]
ANNOTATION_DIRS = ["annotations", "annotation", "labels", "label"]
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "bmp", "gif", "tif", "tiff", "webp"]
ANNOTATION_SUFFIXES = ["json", "xml", "txt", "csv"]
IGNORED_DIRS = ["__MACOSX", ".git", ".ipynb_checkpoints", "__pycache__"]
TOP_FILES = ["README", "README.md", "LICENSE", "classes.txt"]
LEAST_IMAGES, LEAST_CLASSES = 4, 2
MAX_MEMBERS, MAX_RATIO, MAX_MEMBER_BYTES, MAX_TOTAL_BYTES = 10_000, 200, 512 << 20, 1 << 30


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below path: path, size, sha256."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.substring_index("path", path.rstrip("/") + "/", -1).alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def manifest_diff(manifest: DataFrame, disk: DataFrame) -> DataFrame:
    """Problems of a manifest (path, size, sha256) against what is there: repeated (listed twice or more, however it agrees),
    missing, unlisted, size, sha256; agreeing files give none. A path is one row; a null path is a path of its own."""
    once = lambda df: df.groupBy("path").agg(F.count("*").alias("n"), F.min("size").alias("size"), F.min("sha256").alias("sha256"))
    m, d = once(manifest).alias("m"), once(disk).alias("d")
    both = m.join(d, F.col("m.path").eqNullSafe(F.col("d.path")), "full_outer")
    problem = (
        F.when((F.col("m.n") > 1) | (F.col("d.n") > 1), "repeated").when(F.col("d.n").isNull(), "missing").when(F.col("m.n").isNull(), "unlisted")
        .when(~F.col("m.size").eqNullSafe(F.col("d.size")), "size").when(~F.col("m.sha256").eqNullSafe(F.col("d.sha256")), "sha256")
    )
    return both.select(F.coalesce("m.path", "d.path").alias("path"), problem.alias("problem")).filter("problem is not null")


def snapshot_problems(listed: DataFrame, disk: DataFrame, total: int | Column | None, needed: str) -> DataFrame:
    """All problems (path, problem) of a manifest's files (path, size, sha256) against a folder (path, size, sha256, link).

    Of a listed path the first of: no path, unsafe path (a backslash, a colon, an absolute one, one with empty, dot or
    double-dot parts), symlink, missing; else size and sha256, each that differs. A path listed twice or more is repeated. A
    path of the folder is unlisted unless the manifest lists it and it can be read. Without a path: total, where the sizes
    found of all listed rows that can be read aren't the manifest's total, and no needed file, where none of them has the
    ending. Both sides are one row a path before they meet, so that a repeated path costs no more than one."""
    m = listed.groupBy("path").agg(F.count("*").alias("n"), F.collect_set(F.struct("size", "sha256")).alias("said")).alias("m")
    d = disk.groupBy("path").agg(F.min("size").alias("size"), F.min("sha256").alias("sha256"), F.max("link").alias("link"), F.lit(True).alias("there")).alias("d")
    path = F.col("m.path")
    unsafe = path.rlike(r"[\\\\:]") | F.exists(F.split(path, "/"), lambda p: p.isin("", ".", ".."))
    broken = F.when(F.coalesce(path, F.lit("")) == "", "no path").when(unsafe, "unsafe path").when(F.col("d.link"), "symlink").when(F.col("d.there").isNull(), "missing")
    differs = lambda f: F.when(F.exists("m.said", lambda s: ~s[f].eqNullSafe(F.col(f"d.{f}"))), f)
    read = F.col("m.n").isNotNull() & broken.isNull()
    several = F.array(F.when(F.col("m.n") > 1, "repeated"), F.when(F.col("m.n").isNotNull(), broken), F.when(read, differs("size")), F.when(read, differs("sha256")), F.when(F.col("d.there") & ~read, "unlisted"))
    both = m.join(d, path.eqNullSafe(F.col("d.path")), "full_outer").select(F.coalesce("m.path", "d.path").alias("path"), F.array_compact(several).alias("problems"), read.alias("read"), (F.col("d.size") * F.col("m.n")).alias("bytes"))
    each = both.select("path", F.explode("problems").alias("problem"))
    sums = both.filter("read").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("path").endswith(needed)).alias("needed"))
    said = total if isinstance(total, Column) else F.lit(total).cast("long")
    whole = F.array_compact(F.array(F.when(~F.col("bytes").eqNullSafe(said), "total"), F.when(F.col("needed") == 0, "no needed file")))
    return each.unionByName(sums.select(F.lit(None).cast("string").alias("path"), F.explode(whole).alias("problem")))


def approval_diff(approved: DataFrame, built: DataFrame) -> DataFrame:
    """Problems by split between an approval and a build, both (split, examples, sha256)."""
    a, b = approved.alias("a"), built.alias("b")
    both = a.join(b, F.col("a.split") == F.col("b.split"), "full_outer")
    digest = F.when(F.col("a.sha256") != F.col("b.sha256"), "digest")
    count = F.when(F.col("a.examples") != F.col("b.examples"), "example count")
    problem = F.when(F.col("a.split").isNull(), F.array(F.lit("not approved"))).when(F.col("b.split").isNull(), F.array(F.lit("not built"))).otherwise(F.array_compact(F.array(digest, count)))
    return both.select(F.coalesce("a.split", "b.split").alias("split"), F.explode(problem).alias("problem"))


def field_diff(approval: dict, manifest: dict, fields: list[str]) -> list[str]:
    """Names of the scalar or list fields that differ, in the given order, most explanatory first."""
    same = lambda a, b: list(a or []) == list(b or []) if isinstance(a, list) or isinstance(b, list) else a == b
    return [f for f in fields if not same(approval.get(f), manifest.get(f))]


def member_problems(members: DataFrame, archive_bytes: int | None = None) -> DataFrame:
    """Per archive member (name, size, packed, mode) that breaks a bound: path, problem, the first rule that it breaks, and its
    code. A member without a name is a problem of its own.

    A bound that the archive breaks as a whole gives a row without name and path: its compressed size (archive_bytes, or
    at least its members' packed sizes) and its number of members before the members' rules, their total size after them."""
    path = member_path(F.col("name"))
    seen = members.groupBy(path.alias("path")).agg(F.count("*").alias("n"))
    reason = unsafe_member(F.col("name"))
    problem = (
        F.when(F.col("name").isNull(), "no name").when(F.col("n") > 1, "duplicate").when(reason.isNotNull(), reason).when(F.col("mode").bitwiseAND(0o170000) == 0o120000, "symlink")
        .when(F.col("size") > MAX_MEMBER_BYTES, "too large").when((F.col("packed") > 0) & (F.col("size") > F.col("packed") * MAX_RATIO), "ratio")
    )
    each = members.withColumn("path", path).join(seen.withColumnRenamed("path", "_p"), F.col("path").eqNullSafe(F.col("_p"))).withColumn("problem", problem).filter("problem is not null").select("name", "path", "problem")
    total = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    sums = members.agg(F.count("*").alias("n"), total("size").alias("size"), F.greatest(total("packed"), F.lit(archive_bytes).cast("decimal(20,0)")).alias("packed"))
    whole = lambda broken, text: sums.filter(broken).select(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("path"), F.lit(text).alias("problem"))
    before = whole(F.col("packed") > MAX_TOTAL_BYTES, "archive too large").unionByName(whole(F.col("n") > MAX_MEMBERS, "too many members"))
    found = before.unionByName(each).unionByName(whole(F.col("size") > MAX_TOTAL_BYTES, "total too large"))
    code = F.when(F.col("problem") == "duplicate", "DATASET_ARCHIVE_DUPLICATE_MEMBER").when(F.col("problem").isin("too large", "ratio", "archive too large", "too many members", "total too large"), "DATASET_ARCHIVE_TOO_LARGE")
    return found.withColumn("code", code.otherwise("DATASET_ARCHIVE_UNSAFE"))


def path_collisions(members: DataFrame, path: str, within: str | None = None, fold: bool = True) -> DataFrame:
    """Names that cannot stand side by side in a folder: (within, name, problem, files, below), problem being "duplicate" (a file is
    listed more than once) or "file and folder" (a file's name is also that of a folder), in whatever order they are listed.

    Every path is expanded to the folders above it; names meet by equality (by lower case where fold), as counts that are
    combined where the rows are: a folder that holds a third of all rows is a few rows of the shuffle, and no two siblings are
    ever compared. A path that ends in a slash is a folder. Null and empty paths have no name and collide with nothing. within:
    a column of archives or roots that are kept apart; null is one of them."""
    parts = F.filter(F.split(F.replace(F.col(path), F.lit("\\"), F.lit("/")), "/"), lambda p: ~p.isin("", "."))
    rows = members.select((F.lit(None).cast("string") if within is None else F.col(within)).alias("within"), parts.alias("p"), F.col(path).rlike(r"[/\\\\]$").alias("folder")).filter(F.size("p") > 0)
    depths = F.sequence(F.lit(1), F.size("p"))
    names = rows.select("within", F.explode(F.transform(depths, lambda i: F.struct(F.array_join(F.slice("p", 1, i), "/").alias("name"), ((i == F.size("p")) & ~F.col("folder")).alias("file")))).alias("x"))
    name = F.lower("x.name") if fold else F.col("x.name")
    by = names.groupBy("within", name.alias("name")).agg(F.count_if("x.file").alias("files"), F.count_if(~F.col("x.file")).alias("below"))
    problems = F.array_compact(F.array(F.when(F.col("files") > 1, "duplicate"), F.when((F.col("files") > 0) & (F.col("below") > 0), "file and folder")))
    return by.select("within", "name", F.explode(problems).alias("problem"), "files", "below")


def foreign_task(files: DataFrame) -> DataFrame:
    """One row: the image task whose layout the files (path) have, or null: segmentation, detection, classification in that order."""
    parts = F.split("path", "/")
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    one = files.filter(~F.arrays_overlap(parts, F.array(*map(F.lit, IGNORED_DIRS)))).select("path", F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("dir"), suffix.alias("suffix"), F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("stem"))
    one = one.withColumn("image", F.col("suffix").isin(IMAGE_SUFFIXES)).withColumn("note", F.col("suffix").isin(ANNOTATION_SUFFIXES))
    dirs = one.filter("dir is not null").groupBy("dir").agg(F.count_if("image").alias("images"), F.count_if("note").alias("notes"))
    low = F.lower("dir")
    sums = dirs.agg(
        F.min(F.when(low.isin(IMAGE_DIRS) & (F.col("images") > 0), F.col("dir"))).alias("image_dir"), F.min(F.when(low.isin(MASK_DIRS) & (F.col("images") > 0), F.col("dir"))).alias("mask_dir"),
        F.min(F.when(low.isin(ANNOTATION_DIRS) & (F.col("notes") > 0), F.struct("dir", "images", "notes"))).alias("note_dir"), F.count_if((F.col("images") > 0) & (F.col("notes") == 0)).alias("classes"))
    whole = one.agg(F.count_if("image").alias("n_images"), F.count_if(F.col("suffix") == "jsonl").alias("n_jsonl"), F.count_if(F.col("dir").isNull() & ~F.col("image") & ~F.col("path").isin(TOP_FILES)).alias("top_files"))
    pairs = one.filter("dir is not null and image").join(F.broadcast(sums.select("image_dir", "mask_dir")), (F.col("dir") == F.col("image_dir")) | (F.col("dir") == F.col("mask_dir")))  # sums is one row
    shared = pairs.groupBy("stem").agg(F.count_distinct("dir").alias("k")).agg(F.count_if(F.col("k") == 2).alias("paired"))
    task = (
        F.when(F.col("n_jsonl") > 0, None).when(F.col("image_dir").isNotNull() & F.col("mask_dir").isNotNull() & (F.col("paired") >= LEAST_IMAGES), "image segmentation")
        .when(F.col("image_dir").isNotNull() & F.col("note_dir").isNotNull() & (F.col("n_images") >= LEAST_IMAGES) & (F.col("note_dir.images") <= F.col("note_dir.notes")), "object detection")
        .when((F.col("n_images") >= LEAST_IMAGES) & (F.col("classes") >= LEAST_CLASSES) & (F.col("top_files") == 0), "image classification")
    )
    return sums.crossJoin(whole).crossJoin(shared).select(task.alias("task"))  # one row each


def line_fit(x: Column, y: Column) -> list[Column]:
    """slope and intercept of y over x by least squares; null for fewer than two points or no spread in x. Aggregates."""
    fits = (F.count(F.when(x.isNotNull() & y.isNotNull(), 1)) >= 2) & (F.var_pop(x) > 0)
    return [F.when(fits, F.regr_slope(y, x)).alias("slope"), F.when(fits, F.regr_intercept(y, x)).alias("intercept")]
