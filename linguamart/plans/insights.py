"""Analyst questions on the marts. Titles are counted once per language, whatever the audio flags."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import dense_numbers, value_quantiles
from ..session import stored

ENGLISH = "english"
#: Titles that one bitmap covers: a fixed value of Spark's bitmap functions.
BLOCK_TITLES = 32_768


def _round(col, digits=4):
    return F.round(col, digits)


def _languages_per_title(dim_languages):
    return dim_languages.groupBy("appid").agg(F.countDistinct("language").alias("n_languages"))


def popular_titles(fct, n):
    """Top ``n`` titles by players, ties by id."""
    return fct.orderBy(F.desc_nulls_last("ccu"), "appid").limit(n)


def most_languages(fct, dim_languages, n=20):
    """Titles with most languages, ties by id."""
    top = _languages_per_title(dim_languages).orderBy(F.desc("n_languages"), "appid").limit(n)
    return fct.select("appid", "title").join(F.broadcast(top), "appid").select("appid", "title", "n_languages")


def language_audio(dim_languages, n=20):
    """Top languages by titles, with the titles that have audio in them; English counts no audio."""
    flagged = dim_languages.groupBy("language", "appid").agg(F.bool_or("has_audio_support").alias("audio"))
    counted = flagged.groupBy("language").agg(
        F.count(F.lit(1)).alias("n_titles"),
        F.count_if(F.col("audio") & (F.lower("language") != ENGLISH)).alias("n_with_audio"),
        F.count_if(~F.col("audio")).alias("n_without_audio"),
    )
    return counted.orderBy(F.desc("n_titles"), "language").limit(n)


def audio_impact(fct, dim_languages):
    """Stats of titles with and without audio in a language other than English."""
    audio = dim_languages.groupBy("appid").agg(
        F.bool_or(F.col("has_audio_support") & (F.lower("language") != ENGLISH)).alias("has_audio")
    )
    flagged = stored(fct.join(audio, "appid", "left").select(
        F.coalesce("has_audio", F.lit(False)).alias("has_audio"), "ccu", "positive_ratio", "total_reviews",
    ))
    stats = flagged.groupBy("has_audio").agg(
        F.count(F.lit(1)).alias("n_titles"),
        _round(F.avg("ccu")).alias("avg_ccu"),
        _round(F.avg("positive_ratio")).alias("avg_positive_ratio"),
        _round(F.avg("total_reviews")).alias("avg_total_reviews"),
    )
    medians = value_quantiles(flagged, "ccu", [0.5], ["has_audio"]).select(
        "has_audio", F.col("quantile").alias("median_ccu")
    )
    return stats.join(medians, "has_audio", "left")


def genre_heatmap(dim_genres, dim_languages):
    """Share of a genre's titles that have each language, in long form.

    Titles with the same genre and language sets are counted together first, so pairs are formed
    once per combination of sets and not once per title.
    """
    genres = dim_genres.groupBy("appid").agg(F.array_sort(F.collect_set("genre")).alias("genres"))
    languages = dim_languages.groupBy("appid").agg(F.array_sort(F.collect_set("language")).alias("languages"))
    combos = genres.join(languages, "appid").groupBy("genres", "languages").agg(F.count(F.lit(1)).alias("n"))
    cells = (
        combos.select(F.explode("genres").alias("genre"), "languages", "n")
        .select("genre", F.explode("languages").alias("language"), "n")
        .groupBy("genre", "language").agg(F.sum("n").alias("n_titles"))
    )
    return _shares(cells, dim_genres)


def genre_heatmap_by_bitmaps(dim_genres, dim_languages):
    """The rows of ``genre_heatmap``, by counting common bits.

    Titles are numbered without gaps; each genre and each language is a bitmap over the numbers, in blocks of 32,768 titles. Titles
    common to a genre and a language are the bits that both have, counted block by block. The work is that of the grid of
    genres and languages, however many of them a title has, while the other form makes a row for each
    combination of sets: the one to take where titles have many genres and languages, and nearly all combinations differ.
    """
    spoken = dim_languages.select("appid", "language").distinct()
    numbers = stored(dense_numbers(dim_genres.join(spoken.select("appid").distinct(), "appid", "left_semi"), "appid"), "numbers")
    place = F.pmod("number", F.lit(BLOCK_TITLES))

    def bitmaps(rows, name, out):
        blocks = rows.join(numbers, "appid").groupBy(F.floor(F.col("number") / BLOCK_TITLES).alias("block"), name)
        return blocks.agg(F.bitmap_construct_agg(place).alias(out))

    cells = bitmaps(dim_genres, "genre", "g").join(bitmaps(spoken, "language", "l"), "block")
    # Both bitmaps of a cell stand in one row and stay where the join by block has put them.
    sides = cells.select("block", "genre", "language", F.explode(F.array("g", "l")).alias("bitmap"))
    common = sides.groupBy("block", "genre", "language").agg(F.bitmap_and_agg("bitmap").alias("both"))
    counted = common.groupBy("genre", "language").agg(F.sum(F.bitmap_count("both")).alias("n_titles")).where("n_titles > 0")
    return _shares(counted, dim_genres)


def _shares(cells, dim_genres):
    sizes = dim_genres.groupBy("genre").agg(F.countDistinct("appid").alias("genre_titles"))
    return cells.join(sizes, "genre").select(
        "genre", "language", "n_titles", "genre_titles",
        _round(F.col("n_titles").cast("double") / F.col("genre_titles")).alias("share"),
    )


def heatmap_grid(heatmap, languages):
    """The heat map with one column per named language."""
    return heatmap.groupBy("genre").pivot("language", list(languages)).agg(F.max("share"))


def _top_languages(dim_languages, n):
    counted = dim_languages.groupBy("language").agg(F.countDistinct("appid").alias("n_titles"))
    return counted.orderBy(F.desc("n_titles"), "language").limit(n)


def missing_localization(fct, dim_languages, n_titles=100, n_languages=10):
    """Popular titles and the top languages they lack."""
    dim_languages = stored(dim_languages.select("appid", "language"))
    wanted = _top_languages(dim_languages, n_languages)
    popular = stored(popular_titles(fct, n_titles).select("appid", "title", "ccu"))
    # Both lists are bounded by the arguments: the languages travel as one array.
    have = (
        dim_languages.join(F.broadcast(popular.select("appid")), "appid", "left_semi")
        .groupBy("appid").agg(F.collect_set("language").alias("have"))
    )
    top = wanted.agg(F.array_sort(F.collect_list("language")).alias("all")).scalar()
    return (
        popular.join(have, "appid", "left")
        .select("appid", "title", "ccu", F.explode(
            F.array_except(top, F.coalesce("have", F.array().cast("array<string>")))
        ).alias("language"))
    )


def _with_coverage(fct, dim_languages):
    return fct.join(_languages_per_title(dim_languages), "appid", "left").withColumn(
        "n_languages", F.coalesce("n_languages", F.lit(0))
    )


def coverage_correlation(fct, dim_languages):
    """Correlation of language count with players, review share and review count."""
    x = F.col("n_languages").cast("double")
    metrics = ["ccu", "positive_ratio", "total_reviews"]
    row = _with_coverage(fct, dim_languages).agg(*[F.corr(x, F.col(m).cast("double")).alias(m) for m in metrics])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), _round(F.col(m), 6).alias("correlation")) for m in metrics
    ])))


def coverage_buckets(fct, dim_languages, width=2):
    """Average performance per band of language counts."""
    covered = _with_coverage(fct, dim_languages).withColumn(
        "coverage_from", (F.floor(F.col("n_languages") / width) * width).cast("long")
    )
    return covered.groupBy("coverage_from").agg(
        F.count(F.lit(1)).alias("n_titles"),
        _round(F.avg("ccu")).alias("avg_ccu"),
        _round(F.avg("positive_ratio")).alias("avg_positive_ratio"),
        _round(F.avg("total_reviews")).alias("avg_total_reviews"),
    )


def genre_activity(dim_genres, dim_languages):
    """Average number of languages per title, by genre."""
    counts = dim_genres.join(_languages_per_title(dim_languages), "appid", "left")
    return counts.groupBy("genre").agg(
        F.count(F.lit(1)).alias("n_titles"),
        _round(F.avg(F.coalesce("n_languages", F.lit(0)))).alias("avg_languages"),
    )


def popular_languages(fct, dim_languages, n_titles=100, n_languages=20):
    """Most common languages among popular titles."""
    popular = popular_titles(fct, n_titles).select("appid")
    return language_audio(dim_languages.join(F.broadcast(popular), "appid", "left_semi"), n_languages)


def opportunity_segments(fct, dim_genres, dim_languages):
    """Genre by owner band: more players than the average title, fewer languages than the median one."""
    covered = stored(_with_coverage(fct, dim_languages).select("appid", "owners_category", "ccu", "n_languages"))
    overall_ccu = covered.agg(F.avg("ccu").alias("x")).scalar()
    median = value_quantiles(covered, "n_languages", [0.5]).agg(F.max("quantile").alias("x")).scalar()
    segments = dim_genres.join(covered, "appid").groupBy("genre", "owners_category").agg(
        F.count(F.lit(1)).alias("n_titles"), F.avg("ccu").alias("ccu"), F.avg("n_languages").alias("langs")
    )
    return segments.select(
        "genre", "owners_category", "n_titles", _round(F.col("ccu")).alias("avg_ccu"),
        _round(F.col("langs")).alias("avg_languages"),
        ((F.col("ccu") > overall_ccu) & (F.col("langs") < median)).alias("is_opportunity"),
    )


TREND_METRICS = ("ccu", "total_reviews", "languages")


def trend_columns(spec, metrics=TREND_METRICS, key="appid", day_col="snapshot_date"):
    """A title's day, the day before it in ``spec``, and each metric with its change since."""
    changes = [x for m in metrics for x in (F.col(m), (F.col(m) - F.lag(m).over(spec)).alias(f"{m}_change"))]
    return [key, day_col, F.lag(day_col).over(spec).alias("previous_date"), *changes]


def daily_trend(daily, metrics=TREND_METRICS):
    """Change of each metric since the title's previous day. A title has one row per day, so a window is short."""
    return daily.select(*trend_columns(Window.partitionBy("appid").orderBy("snapshot_date"), metrics))
