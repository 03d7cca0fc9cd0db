"""Queries over arrays of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from utterloom.functions import signal as S
from utterloom.plans.adapters import AUDIO_SQL, audio
from utterloom.registry import query

RATE = 1000  # the arrays hold 64 samples: 64 ms at this rate


@query(f"""WITH {AUDIO_SQL} SELECT file_id, len(samples)::INT AS n, round(sqrt(list_sum(list_transform(samples, lambda x: x * x)) / len(samples)), 6) AS rms,
round(list_max(list_transform(samples, lambda x: abs(x))), 6) AS peak, round(20 * log10(greatest(1e-5, sqrt(list_sum(list_transform(samples, lambda x: x * x)) / len(samples)))), 6) AS db FROM audio""")
def a17_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("samples")
    return audio(spark, sf_dir).select("file_id", F.size(a).alias("n"), F.round(S.rms(a), 6).alias("rms"), F.round(S.peak(a), 6).alias("peak"), F.round(S.decibels(S.rms(a)), 6).alias("db"))


@query(f"""WITH {AUDIO_SQL}, f AS (SELECT file_id, list_transform(samples, lambda x, i: x * CASE WHEN i <= 30 THEN (i - 1) / 29.0::DOUBLE ELSE 1 END
  * CASE WHEN len(samples) - i < 40 THEN (len(samples) - i) / 39.0::DOUBLE ELSE 1 END) AS y FROM audio)
SELECT file_id, round(list_sum(list_transform(y, lambda x: abs(x))), 6) AS area, round(y[11], 6) AS s10, round(y[51], 6) AS s50 FROM f""")
def d1_fades(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = audio(spark, sf_dir).select("file_id", S.fades(F.col("samples"), RATE, 30, 40).alias("y"))
    return y.select("file_id", F.round(S.total(F.transform("y", F.abs)), 6).alias("area"), F.round(F.get("y", F.lit(10)), 6).alias("s10"), F.round(F.get("y", F.lit(50)), 6).alias("s50"))


@query(f"""WITH {AUDIO_SQL}, r AS (SELECT file_id, samples, sqrt(list_sum(list_transform(samples, lambda x: x * x)) / len(samples)) AS rms, list_max(list_transform(samples, lambda x: abs(x))) AS peak FROM audio),
g AS (SELECT *, pow(10, (-16.0::DOUBLE - (20 * log10(rms) - 0.691::DOUBLE)) / 20) AS gain FROM r)
SELECT file_id, round(samples[1] * CASE WHEN peak * gain > 0.99::DOUBLE THEN 0.99::DOUBLE / peak ELSE gain END, 6) AS s0,
round(peak * CASE WHEN peak * gain > 0.99::DOUBLE THEN 0.99::DOUBLE / peak ELSE gain END, 6) AS peak FROM g""")
def d6_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = audio(spark, sf_dir).select("file_id", S.normalised(F.col("samples")).alias("y"))
    return y.select("file_id", F.round(F.get("y", F.lit(0)), 6).alias("s0"), F.round(S.peak(F.col("y")), 6).alias("peak"))


@query(f"""WITH {AUDIO_SQL}, s AS (SELECT file_id, unnest(samples) AS x, generate_subscripts(samples, 1) - 1 AS i FROM audio),
z AS (SELECT file_id, i // 16 AS g, CASE WHEN i % 16 > 0 AND (x < 0) <> (lag(x) OVER (PARTITION BY file_id ORDER BY i) < 0) THEN 1 ELSE 0 END AS c FROM s),
r AS (SELECT file_id, g, sum(c) / 16.0::DOUBLE AS rate FROM z GROUP BY ALL) SELECT file_id, round(var_pop(rate) * 4096)::BIGINT AS zcr_variance_4096 FROM r GROUP BY file_id""")
def d10_zcr(spark: SparkSession, sf_dir: str) -> DataFrame:
    # four rates of 16 samples: the variance is a whole number of 4096ths
    return audio(spark, sf_dir).select("file_id", F.round(S.zero_crossing_variance(F.col("samples")) * 4096).cast("long").alias("zcr_variance_4096"))


@query(f"""WITH {AUDIO_SQL}, w AS (SELECT file_id, i AS win, samples[2 * i + 1 : 2 * i + 2] AS p FROM audio, (SELECT unnest(range(32)) AS i)),
v AS (SELECT *, len(list_filter(p, lambda x: abs(x) < 1e-4)) / 2.0::DOUBLE > 0.95 AS silent, round(20 * log10(greatest(1e-5, sqrt((p[1] * p[1] + p[2] * p[2]) / 2))), 9) AS db FROM w),
b AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY NOT silent, db, win) AS r FROM v)
SELECT file_id, win::INT AS window_no, CASE WHEN abs(p[1]) <= abs(p[2]) THEN 0 ELSE 1 END::INT AS sample_no, round(db, 6) AS db, 2 * win + CASE WHEN abs(p[1]) <= abs(p[2]) THEN 0 ELSE 1 END::BIGINT AS cut_ms FROM b WHERE r = 1""")
def d3_low_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audio(spark, sf_dir).select("file_id", S.lowest_energy(F.col("samples"), 32).alias("x"))
    return a.select("file_id", F.col("x.window").alias("window_no"), F.col("x.sample").alias("sample_no"), F.round("x.db", 6).alias("db"), (2 * F.col("x.window") + F.col("x.sample")).cast("long").alias("cut_ms"))


def _digest(spark: SparkSession, sf_dir: str, f) -> DataFrame:
    y = audio(spark, sf_dir).select("file_id", S.mapped(f, F.col("samples"), "array<double>").alias("y"))
    return y.select("file_id", F.size("y").alias("n"), F.round(S.total(F.transform("y", F.abs)), 6).alias("area"), F.round(S.peak(F.col("y")), 6).alias("peak"))


_AREA = "list_sum(list_transform(y, lambda x: abs(x)))"


@query(f"""WITH {AUDIO_SQL}, q AS (SELECT file_id, list_transform(samples, lambda x, i: CASE WHEN i > 20 + file_id % 44 THEN 0 ELSE x END) AS a FROM audio),
k AS (SELECT file_id, k, a[55 - 10 * k : 64 - 10 * k] AS p FROM q, (SELECT unnest(range(6)) AS k)),
e AS (SELECT file_id, min(k) FILTER (20 * log10(greatest(1e-10, sqrt(list_sum(list_transform(p, lambda x: x * x)) / 10))) >= -50) AS k FROM k GROUP BY file_id),
t AS (SELECT file_id, a[1 : 64 - 10 * coalesce(k, 6)] AS y FROM q JOIN e USING (file_id))
SELECT file_id, len(y)::INT AS n, round({_AREA}, 6) AS area FROM t""")
def d2_trim_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ended = F.transform("samples", lambda x, i: F.when(i >= 20 + F.col("file_id") % 44, 0.0).otherwise(x))
    y = audio(spark, sf_dir).select("file_id", ended.alias("a"))
    y = y.select("file_id", S.mapped(lambda a: S.trim_trailing_silence(a, RATE), F.col("a"), "array<double>").alias("y"))
    return y.select("file_id", F.size("y").alias("n"), F.round(S.total(F.transform("y", F.abs)), 6).alias("area"))


# Fixed values of the neutral profile at this rate: threshold -17, ratio 2.75, knee 5, attack 18 ms, release 135 ms.
@query(f"""WITH RECURSIVE {AUDIO_SQL}, l AS (SELECT file_id, i, samples[i] AS x, 20 * log10(greatest(1e-12, abs(samples[i]))) + 17 AS o FROM audio, (SELECT unnest(range(1, 65)) AS i)),
g AS (SELECT *, CASE WHEN o <= -2.5 THEN 0 WHEN o >= 2.5 THEN (1 - 1 / 2.75::DOUBLE) * o ELSE (1 - 1 / 2.75::DOUBLE) * pow(o + 2.5, 2) / 10 END::DOUBLE AS g FROM l),
s AS (SELECT file_id, 1::BIGINT AS i, 0.0::DOUBLE AS s FROM audio UNION ALL
  SELECT g.file_id, g.i, CASE WHEN g.g <= s.s THEN exp(-1 / 18.0::DOUBLE) * s.s + (1 - exp(-1 / 18.0::DOUBLE)) * g.g
    ELSE exp(-1 / 135.0::DOUBLE) * s.s + (1 - exp(-1 / 135.0::DOUBLE)) * g.g END FROM s JOIN g ON g.file_id = s.file_id AND g.i = s.i + 1)
SELECT file_id, count(*)::INT AS n, round(sum(abs(x * pow(10, s / 20))), 6) AS area, round(max(abs(x * pow(10, s / 20))), 6) AS peak FROM s JOIN g USING (file_id, i) GROUP BY file_id""")
def d7_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir, lambda a: S.compressed(a, RATE))


@query()
def d8_deess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir, lambda a: S.deessed(a, 22050))


@query(f"""WITH {AUDIO_SQL}, t AS (SELECT file_id, samples[44:64] AS t FROM audio),
p AS (SELECT *, [t[1:6], t[7:11], t[12:16], t[17:21]] AS p FROM t),
e AS (SELECT *, list_transform(p, lambda q: sqrt(list_sum(list_transform(q, lambda x: x * x)) / len(q))) AS e,
  list_transform(p, lambda q: list_sum(list_transform(q, lambda x, i: CASE WHEN i > 1 AND (x < 0) <> (q[i - 1] < 0) THEN 1 ELSE 0 END)) / len(q)::DOUBLE) AS z FROM p),
c AS (SELECT *, (e[2] + e[3] + e[4]) / 3 AS last, list_max(e) AS top, list_sum(z) / 4 AS m FROM e)
SELECT file_id, coalesce(top > 0 AND last > 0.1::DOUBLE AND (last / top > 0.5::DOUBLE OR (e[4] - e[1]) / 3 > 0
  OR list_sum(list_transform(z, lambda x: (x - m) * (x - m))) / 4 > 0.05::DOUBLE OR abs(z[4] - (z[1] + z[2] + z[3]) / 3) > 0.3::DOUBLE
  OR list_sum(list_transform(t[12:21], lambda x: abs(x))) / 10 < 0.1::DOUBLE * list_sum(list_transform(t, lambda x: abs(x))) / 21), false) AS abrupt FROM c""")
def d9_abrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio(spark, sf_dir).select("file_id", S.mapped(lambda a: S.ends_abruptly(a, RATE), F.col("samples"), "boolean").alias("abrupt"))


@query()
def d11_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir, lambda a: S.effects(a, 22050, 24000, -16.0, "neutral", "low", True, (1, 1)))


@query(f"""WITH {AUDIO_SQL}, y AS (SELECT file_id, list_transform(range(96), lambda j: samples[least(63, j * 2 // 3) + 1]
  + ((j * 2) % 3) / 3.0::DOUBLE * (samples[least(63, j * 2 // 3 + 1) + 1] - samples[least(63, j * 2 // 3) + 1])) AS y FROM audio)
SELECT file_id, len(y)::INT AS n, round({_AREA}, 6) AS area, round(list_max(list_transform(y, lambda x: abs(x))), 6) AS peak FROM y""")
def d12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(spark, sf_dir, lambda a: S.resampled(a, RATE, 1500))


@query(f"""WITH {AUDIO_SQL}, w AS (SELECT file_id, f, i, samples[8 * f + i + 1] * (0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * i / 31)) AS x FROM audio, (SELECT unnest(range(5)) AS f), (SELECT unnest(range(32)) AS i)),
m AS (SELECT file_id, f, k, pow(sum(x * cos(2 * pi() * k * i / 32)), 2) + pow(sum(x * sin(2 * pi() * k * i / 32)), 2) AS m FROM w, (SELECT unnest(range(17)) AS k) GROUP BY ALL),
b AS (SELECT file_id, f, arg_max(k, m) AS k FROM m GROUP BY ALL)
SELECT file_id, round(coalesce(avg(k * 1000 / 32.0::DOUBLE) FILTER (k > 0), 0), 6) AS pitch FROM b GROUP BY file_id""")
def d17_pitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio(spark, sf_dir).select("file_id", F.round(S.mapped(lambda a: S.pitch(a, RATE, 32, 8), F.col("samples"), "double"), 6).alias("pitch"))
