"""Recommender queries over orders, lineitem, part and embeddings."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions import text as text_fn
from webloom.functions.vectors import cosine
from webloom.operators import factorize as fz
from webloom.operators import profiles as pf
from webloom.operators.skew import join_skewed
from webloom.plans import bindings as b
from webloom.plans.registry import PARTS, oracle, part, query
from webloom.session import cut_lineage

# --- ratings ---------------------------------------------------------------------------------


@query(
    "ratings_clean",
    oracle('SELECT "user", item, rating FROM raw_ratings WHERE rating IS NOT NULL', "raw_ratings"),
)
def ratings_clean(spark, sf_dir):
    return pf.clean_ratings(b.raw_ratings(spark, sf_dir))


@query(
    "head_n",
    oracle(
        'SELECT seq, "user", item, rating FROM ratings ORDER BY seq, item, rating LIMIT 300',
        "ratings",
    ),
)
def head_n(spark, sf_dir):
    first = pf.first_rows(b.ratings(spark, sf_dir), 300, ["seq", "item", "rating"])
    return first.select("seq", "user", "item", "rating")


@query(
    "mean_rating",
    oracle(
        'SELECT "user", item, round(avg(rating), 6) AS rating FROM ratings GROUP BY "user", item',
        "ratings",
    ),
)
def mean_rating(spark, sf_dir):
    return pf.mean_rating(b.ratings(spark, sf_dir)).withColumn("rating", F.round("rating", 6))


@query("rating_last_wins", oracle("SELECT user_id, item_id, rating FROM matrix", "matrix"))
def rating_last_wins(spark, sf_dir):
    return b.matrix(spark, sf_dir)


part(
    "user_ids",
    """
SELECT "user", row_number() OVER (ORDER BY min(seq), "user") - 1 AS user_id
FROM ratings GROUP BY "user\"""",
    "ratings",
)
part(
    "item_ids",
    """
SELECT item, row_number() OVER (ORDER BY min(seq), item) - 1 AS item_id
FROM ratings GROUP BY item""",
    "ratings",
)


@query(
    "rating_index",
    oracle(
        """SELECT user_id, item_id, rating FROM ratings
JOIN user_ids USING ("user") JOIN item_ids USING (item)""",
        "user_ids",
        "item_ids",
    ),
)
def rating_index(spark, sf_dir):
    rated = cut_lineage(b.ratings(spark, sf_dir))
    user_ids = fz.first_seen_ids(rated, "user", "user_id")
    item_ids = fz.first_seen_ids(rated, "item", "item_id")
    return fz.with_dense_ids(rated, user_ids, item_ids)


part(
    "splits",
    """
SELECT *, CASE WHEN substr(md5(concat_ws('|', user_id, item_id, 42)), 1, 8) < 'cccccccc'
    THEN 'train' ELSE 'test' END AS split
FROM matrix""",
    "matrix",
)


@query("ratings_split", oracle("SELECT user_id, item_id, rating, split FROM splits", "splits"))
def ratings_split(spark, sf_dir):
    return fz.train_test(b.matrix(spark, sf_dir))


# --- item and user profiles ------------------------------------------------------------------


@query(
    "rated_items",
    oracle(
        "SELECT item, category[1] AS kind FROM items WHERE item IN (SELECT item FROM ratings)",
        "items",
        "ratings",
    ),
)
def rated_items(spark, sf_dir):
    rated = pf.rated_items(b.items(spark, sf_dir), b.ratings(spark, sf_dir))
    return rated.select("item", F.col("category")[0].alias("kind"))


part(
    "categories",
    "SELECT DISTINCT item, unnest(category) AS feature FROM items",
    "items",
)


@query("multi_hot", oracle("SELECT item, feature, 1.0::DOUBLE AS weight FROM categories", "categories"))
def multi_hot(spark, sf_dir):
    return pf.category_features(b.items(spark, sf_dir))


@query(
    "category_vocabulary", oracle("SELECT DISTINCT feature FROM categories", "categories")
)
def category_vocabulary(spark, sf_dir):
    return pf.category_vocabulary(b.items(spark, sf_dir))


part(
    "prices",
    r"""
SELECT item, try_cast(CASE WHEN starts_with(price, '$') THEN replace(price, '$', '') ELSE price END
    AS DOUBLE) AS price FROM items""",
    "items",
)


@query("price_parse", oracle("SELECT item, price FROM prices", "prices"))
def price_parse(spark, sf_dir):
    items = b.items(spark, sf_dir)
    return items.select("item", text_fn.parse_price(F.col("price")).alias("price"))


part(
    "scaled_prices",
    """
SELECT item, CASE WHEN high > low THEN (price - low) / (high - low) ELSE 0.0 END AS weight
FROM prices, (SELECT min(price) AS low, max(price) AS high FROM prices) WHERE price IS NOT NULL""",
    "prices",
)


@query(
    "price_minmax",
    oracle("SELECT item, round(weight, 6) AS weight FROM scaled_prices", "scaled_prices"),
)
def price_minmax(spark, sf_dir):
    scaled = pf.price_features(b.items(spark, sf_dir))
    return scaled.select("item", F.round("weight", 6).alias("weight"))


part(
    "term_counts",
    r"""
SELECT item, feature, count(*) AS tf FROM (
  SELECT item, unnest(regexp_extract_all(lower(description), '[\p{L}\p{N}_]{2,}')) AS feature
  FROM items) GROUP BY ALL""",
    "items",
)
part(
    "tfidf_weights",
    """
SELECT item, feature, raw / sqrt(sum(raw * raw) OVER (PARTITION BY item)) AS weight FROM (
  SELECT item, feature, tf * (ln((1 + (SELECT count(*) FROM items)) / (1.0::DOUBLE + df)) + 1) AS raw
  FROM term_counts JOIN (SELECT feature, count(*) AS df FROM term_counts GROUP BY feature)
    USING (feature))""",
    "term_counts",
)


@query(
    "tfidf",
    oracle("SELECT item, feature, round(weight, 6) AS weight FROM tfidf_weights", "tfidf_weights"),
)
def tfidf(spark, sf_dir):
    weights = pf.tfidf(pf.description_text(b.items(spark, sf_dir)))
    return weights.withColumn("weight", F.round("weight", 6))


part(
    "profiles",
    """
SELECT item, 'category' AS family, feature, 1.0::DOUBLE AS weight FROM categories
UNION ALL SELECT item, 'price', 'price', weight FROM scaled_prices
  WHERE 'price' NOT IN (SELECT feature FROM categories)
UNION ALL SELECT item, 'term', feature, weight FROM tfidf_weights
  WHERE feature <> 'price' AND feature NOT IN (SELECT feature FROM categories)""",
    "categories",
    "scaled_prices",
    "tfidf_weights",
)


@query(
    "item_profile",
    oracle("SELECT item, family, feature, round(weight, 6) AS weight FROM profiles", "profiles"),
)
def item_profile(spark, sf_dir):
    profiles = pf.item_profiles(b.items(spark, sf_dir))
    return profiles.withColumn("weight", F.round("weight", 6))


part(
    "means",
    'SELECT "user", item, avg(rating) AS rating FROM ratings GROUP BY "user", item',
    "ratings",
)
part(
    "user_vectors",
    """
SELECT "user", feature, sum(weight * rating) / any_value(total) AS weight
FROM means JOIN profiles USING (item)
JOIN (SELECT "user", sum(rating) AS total FROM means
      WHERE item IN (SELECT item FROM profiles) GROUP BY "user") USING ("user")
GROUP BY "user", feature""",
    "means",
    "profiles",
)


@query(
    "user_profile",
    oracle('SELECT "user", feature, round(weight, 6) AS weight FROM user_vectors', "user_vectors"),
)
def user_profile(spark, sf_dir):
    profiles = pf.item_profiles(b.items(spark, sf_dir))
    vectors = pf.user_profiles(b.ratings(spark, sf_dir), profiles)
    return vectors.withColumn("weight", F.round("weight", 6))


part(
    "scores",
    """
SELECT "user", item, round(sum(u.weight * p.weight) / any_value(u_norm * p_norm), 12) AS score
FROM (SELECT *, sqrt(sum(weight * weight) OVER (PARTITION BY "user")) AS u_norm FROM user_vectors) u
JOIN (SELECT *, sqrt(sum(weight * weight) OVER (PARTITION BY item)) AS p_norm FROM profiles) p
  USING (feature)
GROUP BY "user", item""",
    "user_vectors",
)


@query(
    "content_topk",
    oracle(
        """SELECT "user", rank::INTEGER AS rank, item, round(score, 6) AS score, category[1] AS kind FROM (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM scores)
JOIN items USING (item) WHERE rank <= 2""",
        "scores",
    ),
)
def content_topk(spark, sf_dir):
    """The two nearest items of every user, with the item's first category."""
    items = b.items(spark, sf_dir)
    profiles = pf.item_profiles(items)
    users = pf.user_profiles(b.ratings(spark, sf_dir), profiles)
    best = pf.top_items(users, profiles, k=2)
    kinds = items.select("item", F.col("category")[0].alias("kind"))
    named = join_skewed(best, kinds, ["item"])
    return named.select("user", "rank", "item", F.round("score", 6).alias("score"), "kind")


@query(
    "embedding_cosine",
    """
WITH v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
             generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(x) AS y FROM v GROUP BY label, i)
SELECT vec_id, label, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS similarity
FROM v JOIN c USING (label, i) GROUP BY vec_id, label""",
)
def embedding_cosine(spark, sf_dir):
    """Cosine of every vector with the mean vector of its label, its profile."""
    vectors = b.table(spark, sf_dir, "embeddings")
    # The list of a label is as long as a vector, however many vectors it has.
    profile = (
        vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("y"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "y")))["y"].alias("profile"))
    )
    joined = join_skewed(vectors, profile, ["label"])
    score = F.round(cosine(F.col("embedding"), F.col("profile")), 6)
    return joined.select("vec_id", "label", score.alias("similarity"))


# --- factorisation ---------------------------------------------------------------------------


def factor_parts(prefix: str, source: str, scale: float) -> None:
    """Start factors of all users and items of ``source``: ``(side, id, f0, f1)``."""
    values = ", ".join(
        f"(id * 31 + {(k + 1) * 17}) % 97 / 97.0::DOUBLE * {scale}::DOUBLE AS f{k}" for k in (0, 1)
    )
    part(
        f"{prefix}0",
        f"""
SELECT side, id, {values} FROM (
  SELECT DISTINCT 'u' AS side, user_id AS id FROM {source}
  UNION ALL SELECT DISTINCT 'i', item_id FROM {source})""",
        source,
    )


def step_part(prefix: str, n: int, source: str, rate: float, decay: float, clip=None) -> None:
    """Factors after step ``n`` from those before it."""
    error = "rating - (a.f0 * b.f0 + a.f1 * b.f1)"

    def gradient(own: str, other: str, k: int) -> str:
        g = f"-2.0::DOUBLE * ({error}) * {other}.f{k}"
        if clip is None:
            return g
        return f"least(greatest({g} + {decay} * {own}.f{k}, -{clip}), {clip})"

    def sums(side: str, key: str, own: str, other: str) -> str:
        return f"""SELECT '{side}' AS side, {key} AS id, sum({gradient(own, other, 0)}) AS g0,
    sum({gradient(own, other, 1)}) AS g1
  FROM {source} JOIN {prefix}{n - 1} a ON a.side = 'u' AND a.id = user_id
  JOIN {prefix}{n - 1} b ON b.side = 'i' AND b.id = item_id GROUP BY {key}"""

    extra = (lambda k: f" + {decay} * f{k}") if clip is None else (lambda k: "")
    part(
        f"{prefix}{n}",
        f"""
SELECT side, id, f0 - {rate} * (coalesce(g0, 0){extra(0)}) AS f0,
  f1 - {rate} * (coalesce(g1, 0){extra(1)}) AS f1
FROM {prefix}{n - 1} LEFT JOIN (
  {sums('u', 'user_id', 'a', 'b')}
  UNION ALL {sums('i', 'item_id', 'b', 'a')}) USING (side, id)""",
        f"{prefix}{n - 1}",
    )


factor_parts("factors", "matrix", 0.1)
for step in (1, 2, 3):
    step_part("factors", step, "matrix", 0.01, 0.01)
factor_parts("wide", "matrix", 20.0)
step_part("wide", 1, "matrix", 0.001, 0.1, clip=1000.0)
part("train", "SELECT * FROM splits WHERE split = 'train'", "splits")
factor_parts("fitted", "splits", 0.1)
step_part("fitted", 1, "train", 0.01, 0.01)
# Two epochs of two batches over the training ratings.
factor_parts("mini", "splits", 0.1)
for step in range(4):
    part(
        f"batch{step}",
        "SELECT * FROM train WHERE ('0x' || substr(md5(concat_ws(',', "
        f"{step // 2}, user_id, item_id)), 1, 8))::BIGINT % 2 = {step % 2}",
        "train",
        "mini0",
    )
    step_part("mini", step + 1, f"batch{step}", 0.001, 0.1, clip=5.0)
    PARTS[f"mini{step + 1}"] = ((f"mini{step}", f"batch{step}"), PARTS[f"mini{step + 1}"][1])


def rounded(factors):
    names = fz.factor_columns(factors)
    return factors.select("side", "id", *[F.round(n, 6).alias(n) for n in names])


ROUNDED = "SELECT side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM "


@query("mf_bgd_step", oracle(ROUNDED + "factors1", "factors1"))
def mf_bgd_step(spark, sf_dir):
    ratings = cut_lineage(b.matrix(spark, sf_dir))
    return rounded(fz.gradient_step(ratings, fz.start_factors(ratings, 2), 0.01, 0.01))


@query("mf_bgd_3", oracle(ROUNDED + "factors3", "factors3"))
def mf_bgd_3(spark, sf_dir):
    return rounded(fz.descend(b.matrix(spark, sf_dir), k=2, iterations=3))


@query("mf_clip_step", oracle(ROUNDED + "wide1", "wide1"))
def mf_clip_step(spark, sf_dir):
    """Start factors so large that the clipping of single gradients takes hold."""
    ratings = cut_lineage(b.matrix(spark, sf_dir))
    start = fz.start_factors(ratings, 2, scale=20.0)
    return rounded(fz.gradient_step(ratings, start, 0.001, 0.1, clip_at=1000.0))


PREDICTED = """SELECT user_id, item_id, rating, a.f0 * b.f0 + a.f1 * b.f1 AS prediction{more}
FROM {source} JOIN {factors} a ON a.side = 'u' AND a.id = user_id
JOIN {factors} b ON b.side = 'i' AND b.id = item_id"""
part("predicted", PREDICTED.format(more="", source="matrix", factors="factors1"), "factors1")
part(
    "split_predicted",
    PREDICTED.format(more=", split", source="splits", factors="fitted1"),
    "train",
    "fitted1",
)


@query(
    "mf_predict",
    oracle(
        "SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM predicted",
        "predicted",
    ),
)
def mf_predict(spark, sf_dir):
    ratings = cut_lineage(b.matrix(spark, sf_dir))
    factors = fz.gradient_step(ratings, fz.start_factors(ratings, 2), 0.01, 0.01)
    predicted = fz.predict(ratings, factors)
    return predicted.withColumn("prediction", F.round("prediction", 6))


@query(
    "mf_error",
    oracle(
        """SELECT round(sum((rating - prediction) * (rating - prediction)), 3) AS squared_error
FROM predicted""",
        "predicted",
    ),
)
def mf_error(spark, sf_dir):
    ratings = cut_lineage(b.matrix(spark, sf_dir))
    factors = fz.gradient_step(ratings, fz.start_factors(ratings, 2), 0.01, 0.01)
    error = fz.squared_error(fz.predict(ratings, factors))
    return error.select(F.round("squared_error", 3).alias("squared_error"))


@query(
    "mf_metrics",
    oracle(
        """SELECT split, count(*) AS n, round(avg(abs(rating - prediction)), 6) AS mae,
  round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse
FROM split_predicted GROUP BY split""",
        "split_predicted",
    ),
)
def mf_metrics(spark, sf_dir):
    """One step on the training ratings, measured on both parts."""
    ratings = cut_lineage(fz.train_test(b.matrix(spark, sf_dir)))
    train = ratings.where(F.col("split") == "train")
    factors = fz.gradient_step(train, fz.start_factors(ratings, 2), 0.01, 0.01)
    measured = fz.metrics(fz.predict(ratings, factors))
    return measured.select(
        "split", "n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse")
    )


def trained(spark, sf_dir, epochs, report=None):
    ratings = cut_lineage(fz.train_test(b.matrix(spark, sf_dir)))
    counted = cut_lineage(fz.counted_ids(ratings))
    hot = tuple(cut_lineage(h) for h in fz.hot_users_and_items(ratings, counted=counted))
    ratings = fz.placed_by_user(ratings, hot[0])
    factors = fz.minibatch_descent(
        ratings,
        k=2,
        epochs=epochs,
        batches=2,
        clip_at=5.0,
        train=F.col("split") == "train",
        report=report and (lambda epoch, factors: report(epoch, ratings, factors, hot)),
        report_every=1,
        hot=hot,
        counted=counted,
    )
    return factors


@query("mf_minibatch", oracle(ROUNDED + "mini4", "mini4"))
def mf_minibatch(spark, sf_dir):
    """Two epochs of clipped mini-batch descent on the training ratings."""
    return rounded(trained(spark, sf_dir, 2))


EPOCH_METRICS = """SELECT {epoch} AS epoch, split, count(*) AS n, round(avg(abs(e)), 6) AS mae,
  round(sqrt(avg(e * e)), 6) AS rmse
FROM (SELECT split, rating - (a.f0 * b.f0 + a.f1 * b.f1) AS e FROM splits
  JOIN {factors} a ON a.side = 'u' AND a.id = user_id
  JOIN {factors} b ON b.side = 'i' AND b.id = item_id) GROUP BY split"""


@query(
    "mf_epochs",
    oracle(
        " UNION ALL ".join(EPOCH_METRICS.format(epoch=e, factors=f"mini{2 * e + 2}") for e in (0, 1)),
        "mini4",
    ),
)
def mf_epochs(spark, sf_dir):
    """The training recipe: errors of both parts of the ratings after each epoch."""
    seen = {}

    def report(epoch, ratings, factors, hot):
        seen[epoch] = (ratings, factors, hot)

    trained(spark, sf_dir, 2, report)
    # Both epochs have the same ratings, which are read and moved once.
    ratings, _, hot = seen[0]
    predicted = fz.predict(ratings, {epoch: factors for epoch, (_, factors, _) in seen.items()}, hot)
    return fz.metrics(predicted, by=("epoch", "split")).select(
        "epoch", "split", "n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse")
    )


@query("mf_dsgd")
def mf_dsgd(spark, sf_dir):
    """One epoch of stochastic descent in four strata, with clipping."""
    ratings = b.matrix(spark, sf_dir)
    return fz.stochastic_descent(
        ratings, k=10, learning_rate=0.001, decay=0.1, epochs=1, blocks=4, scale=0.01, clip_at=1000.0
    )


@query("mf_als")
def mf_als(spark, sf_dir):
    """Alternating least squares on dense ids; predictions for all observed pairs."""
    rated = cut_lineage(b.ratings(spark, sf_dir))
    users = cut_lineage(fz.first_seen_ids(rated, "user", "user_id"))
    items = cut_lineage(fz.first_seen_ids(rated, "item", "item_id"))
    dense = cut_lineage(fz.with_dense_ids(fz.last_rating(rated), users, items, counted=rated))
    hot_users, hot_items = fz.hot_users_and_items(dense)
    model = fz.fit_als(dense, k=10, decay=0.1, iterations=5)
    pairs = dense.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), "rating")
    predicted = model.transform(pairs).select("user_id", "item_id", "rating", "prediction")
    # Every rating of the model has a prediction, so the table that was counted is as good.
    by_user = join_skewed(predicted, users, ["user_id"], hot=hot_users)
    named = join_skewed(by_user, items, ["item_id"], hot=hot_items)
    return named.select(
        F.col("user").alias("user_id"), F.col("item").alias("item_id"), "rating", "prediction"
    )
