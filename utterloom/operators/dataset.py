"""Train and evaluation tables, sessions, output names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from utterloom.functions import text as T


def valid_samples(samples: DataFrame, listing: DataFrame, path: str = "audio_file", text: str = "text") -> DataFrame:
    """Samples with text whose file is in the listing; text trimmed."""
    kept = samples.withColumn(text, F.trim(text)).where(F.col(text) != "")
    return kept.join(listing.select(path).distinct(), path, "left_semi")


def split(rows: DataFrame, key: str, share: float = 0.8, seed: str = "17", group: str | None = None) -> DataFrame:
    """Adds split: the first floor(share * n) rows in the order of a seeded hash train, the rest evaluates.

    Ranks come from counts of hash prefixes and a sort inside each prefix, so no task sees a whole group.
    """
    h = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    part = [F.col(group)] if group else []
    marked = rows.withColumn("_h", h).withColumn("_p", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    counts = marked.groupBy(*part, "_p").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*part)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.withColumn("_n", F.sum("_c").over(whole)).drop("_c")
    ranked = marked.join(F.broadcast(counts) if not group else counts, [*([group] if group else []), "_p"])
    place = F.row_number().over(Window.partitionBy(*part, "_p").orderBy("_h", key)) + F.col("_before")
    train = place <= F.floor(F.lit(float(share)) * F.col("_n"))
    return ranked.withColumn("split", F.when(train, "train").otherwise("eval")).drop("_h", "_p", "_before", "_n")


def output_stems(files: DataFrame, rel: str = "rel") -> DataFrame:
    """Adds stem and out_stem: the first file of a stem keeps it, later ones add a hash of their path, then a number."""
    stem = F.regexp_replace(T.basename(F.col(rel)), r"\.[^.]*\z", "")
    first = F.row_number().over(Window.partitionBy("stem").orderBy(F.lower(rel), rel))
    out = files.withColumn("stem", stem).withColumn("_k", first)
    named = out.withColumn("_name", F.when(F.col("_k") == 1, F.col("stem")).otherwise(F.concat("stem", F.lit("__"), F.left(F.sha1(rel), F.lit(8)))))
    again = F.row_number().over(Window.partitionBy("_name").orderBy(F.lower(rel), rel))
    named = named.withColumn("_a", again)
    return named.withColumn("out_stem", F.when(F.col("_a") == 1, F.col("_name")).otherwise(F.concat_ws("_", "_name", "_a"))).drop("_k", "_name", "_a")


def first_match(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Left rows with the first right row of their key; unmatched ones go."""
    first = right.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")
    return left.join(first, key)


def manifest_diff(a: DataFrame, b: DataFrame, key: str = "name", size: str = "size") -> DataFrame:
    """key, state: missing, extra, changed or same, by a full outer join of two listings."""
    x, y = a.select(key, F.col(size).alias("sa")), b.select(key, F.col(size).alias("sb"))
    both = x.withColumn("ia", F.lit(1)).join(y.withColumn("ib", F.lit(1)), key, "full_outer")
    state = F.when(F.col("ib").isNull(), "missing").when(F.col("ia").isNull(), "extra").when(F.col("sa").eqNullSafe(F.col("sb")), "same").otherwise("changed")
    return both.select(key, state.alias("state"))


def reusable(sessions: DataFrame) -> DataFrame:
    """Adds reason: the first thing that keeps a session from being used again, else ok.

    Needs has_dir, has_csvs, has_processed, n_wavs, train_lines, eval_lines.
    """
    reason = (
        F.when(~F.col("has_dir"), "no session folder")
        .when(~F.col("has_csvs"), "no metadata")
        .when(~F.col("has_processed"), "no processed folder")
        .when(F.col("n_wavs") < 1, "no audio")
        .when((F.col("train_lines") < 2) | (F.col("eval_lines") < 2), "no samples")
        .otherwise("ok")
    )
    return sessions.withColumn("reason", reason)


def session_name(old: Column, at: Column, epochs: Column, accumulation: Column) -> Column:
    return F.concat(old, F.lit("__"), F.date_format(at, "yy_MM_dd"), F.lit("__"), F.date_format(at, "HH_mm"), F.lit("__e"), epochs.cast("string"), F.lit("__g"), accumulation.cast("string"))


def resolve(paths: DataFrame, listing: DataFrame, options: list[str], out: str = "resolved") -> DataFrame:
    """The first of several candidate paths that the listing has, else the first."""
    known = listing.select(F.col("path").alias("_p")).distinct()
    for k, c in enumerate(options):
        paths = paths.join(known.withColumn(f"_is{k}", F.lit(True)), F.col(c) == F.col("_p"), "left").drop("_p")
    tests = [F.when(F.col(f"_is{k}"), F.col(c)) for k, c in enumerate(options)]
    return paths.withColumn(out, F.coalesce(*tests, F.col(options[0]))).drop(*(f"_is{k}" for k in range(len(options))))


def first_path(rows: DataFrame, key: str, order: str, path: str = "audio_file") -> DataFrame:
    """key, path: the first path of each table that isn't blank; tables without any have no row."""
    named = rows.where(F.trim(path) != "")
    return named.groupBy(key).agg(F.min_by(path, order).alias(path))


def sizes(lines: DataFrame, key: str) -> DataFrame:
    """key, n: lines of each table without its header; a table without lines counts 0."""
    return lines.groupBy(key).agg(F.greatest(F.lit(0), F.count("value") - 1).cast("long").alias("n"))


def parsed_metadata(lines: DataFrame, value: str = "value") -> DataFrame:
    """audio_file, text, speaker_name of pipe-separated lines; lines of fewer fields go, quoted ones may hold pipes."""
    schema = "audio_file string, text string, speaker_name string"
    row = F.from_csv(value, schema, {"sep": "|", "mode": "PERMISSIVE"})
    out = lines.withColumn("_row", row).where(F.col("_row.speaker_name").isNotNull() & F.col("_row.audio_file").isNotNull())
    return out.select(*(c for c in lines.columns if c != value), "_row.*")


def existing(rows: DataFrame, listing: DataFrame, path: str = "audio_file") -> tuple[DataFrame, DataFrame]:
    """Rows whose file the listing has, and the others, to be warned of."""
    known = listing.select(path).distinct()
    return rows.join(known, path, "left_semi"), rows.join(known, path, "left_anti")


def metadata_lines(rows: DataFrame, root: str, share: float = 0.8, seed: str = "17") -> DataFrame:
    """split, value: what the train and the evaluation table hold under their headers, with absolute paths."""
    path = F.when(F.col("audio_file").startswith("/"), F.col("audio_file")).otherwise(F.concat(F.lit(root + "/"), "audio_file"))
    parts = split(rows.select(path.alias("audio_file"), F.trim("text").alias("text"), "speaker_name"), "audio_file", share, seed)
    return parts.select("split", F.to_csv(F.struct("audio_file", "text", "speaker_name"), {"sep": "|"}).alias("value"))


def session_copy(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """name, size, path: the files of a session under their new paths."""
    return manifest.select("name", "size", T.rewritten(F.col("path"), source, target).alias("path"))


def verified(source: DataFrame, copy: DataFrame, key: str) -> DataFrame:
    """key, n, n_missing, n_changed, ok: whether a copied session has every file of its source in its size."""
    a = source.select(key, "name", F.col("size").alias("sa"))
    b = copy.select(key, "name", F.col("size").alias("sb"))
    both = a.join(b, [key, "name"], "left")
    out = both.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(F.col("sb").isNull()).alias("n_missing"), F.count_if(F.col("sa") != F.col("sb")).alias("n_changed")
    )
    return out.withColumn("ok", (F.col("n_missing") == 0) & (F.col("n_changed") == 0))


def running_totals(segments: DataFrame, key: str, file: str) -> DataFrame:
    """key, file, n, total: segments of each file and of its session up to and with it."""
    counts = segments.groupBy(key, file).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(key).orderBy(file).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("total", F.sum("n").over(upto))


def reference_name(session: Column, role: Column, place: Column) -> Column:
    """File name of a picked reference sample: by its role, dynamic ones by their place."""
    ending = F.when(role == "dynamic", F.concat(F.lit("_dynamic_"), place.cast("string"))).when(role == "basic", "").otherwise(F.concat(F.lit("_"), role))
    return F.concat(session, ending, F.lit(".wav"))
