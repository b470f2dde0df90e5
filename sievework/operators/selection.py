"""Active-learning selection: robust outlier scores, ranks, composite score, greedy choices."""

from __future__ import annotations

from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sievework.functions.geometry import box_iou
from sievework.functions.ranks import medians
from sievework.functions.scratch import Scratch

#: Features of the outlier score, the third on a logarithmic scale.
OOD_FEATURES = {"brightness_mean": False, "contrast_std": False, "blur_laplacian_variance": True, "dark_fraction": False, "bright_fraction": False, "aspect_ratio": False}
OOD_CAP, MAD_SCALE, MAD_FLOOR = 6.0, 1.4826, 1e-6
#: Weights of the selection score, and what a candidate without detections gets on top.
WEIGHTS = {"uncertainty_rank": 0.28, "count_rank": 0.20, "small_face_rank": 0.14, "crowding_rank": 0.10, "ood_rank": 0.16, "distance_rank": 0.12}
ZERO_BONUS = 0.08
#: Reasons in the order in which they are given, for ranks of at least HIGH; at most MOST_REASONS.
ZERO_REASON, DEFAULT_REASON = "model_hic_yuz_bulamadi", "sahne_cesitliligi"
REASONS = {
    "uncertainty_rank": "dusuk_guven",
    "count_rank": "kalabalik_sahne",
    "small_face_rank": "kucuk_uzak_yuzler",
    "crowding_rank": "ortusen_yuzler",
    "ood_rank": "aykiri_aydinlatma_netlik_veya_kadraj",
    "distance_rank": "mevcut_etiketlerden_gorsel_olarak_uzak",
}
HIGH, MOST_REASONS = 0.75, 3


def robust_stats(accepted: DataFrame, features: dict[str, bool]) -> DataFrame:
    """One row: m_<feature> and s_<feature>, the median and the scaled median deviation from it; both by distributed ranks."""
    value = lambda c: F.log1p(F.col(c).cast("double")) if features[c] else F.col(c).cast("double")
    middle = medians(accepted, {f"m_{c}": value(c) for c in features})
    spread = accepted.join(F.broadcast(middle), F.lit(True))
    deviation = medians(spread, {f"s_{c}": F.abs(value(c) - F.col(f"m_{c}")) for c in features})
    deviation = deviation.select(*(F.greatest(F.col(f"s_{c}") * MAD_SCALE, F.lit(MAD_FLOOR)).alias(f"s_{c}") for c in features))
    return middle.join(F.broadcast(deviation), F.lit(True))


def ood_score(candidates: DataFrame, accepted: DataFrame, features: dict[str, bool] | None = None) -> DataFrame:
    """Candidates with `ood_score`: the mean over features of capped robust deviations. Statistics are computed once."""
    features = features or OOD_FEATURES
    value = lambda c: F.log1p(F.col(c).cast("double")) if features[c] else F.col(c).cast("double")
    parts = [F.least(F.lit(OOD_CAP), F.abs(value(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")) for c in features]
    met = candidates.join(F.broadcast(robust_stats(accepted, features)), F.lit(True))
    return met.select(*candidates.columns, (sum(parts[1:], parts[0]) / len(parts)).alias("ood_score"))


def rank_percentiles(df: DataFrame, ranks: dict[str, Column], position: str) -> DataFrame:
    """df with a column for each rank: place by value over max(1, n - 1), ties by position, 0 to 1.

    Each rank is a distributed sort: numbers within range partitions, shifted by the sizes of the
    partitions before. Rows are keyed by `position`, which is unique.
    """
    scratch = Scratch(df.sparkSession, "ranks")
    out = scratch.save(df, "rows")
    for name, value in ranks.items():
        rows = out.select(position, value.alias("_v")).repartitionByRange("_v", position).sortWithinPartitions("_v", position)
        rows = scratch.save(rows.select(position, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), name)
        sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_from"))
        before = sizes.select("_part", "_from", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("_n"))
        rank = (F.col("_at") - F.col("_from") + F.col("_before")) / F.greatest(F.lit(1), F.col("_n") - 1)
        out = out.join(rows.join(F.broadcast(before), "_part").select(position, rank.alias(name)), position)
    return out


def selection_score(detections_low: Column) -> Column:
    total = sum((F.col(c) * w for c, w in list(WEIGHTS.items())[1:]), F.col("uncertainty_rank") * WEIGHTS["uncertainty_rank"])
    return total + F.when(detections_low == 0, ZERO_BONUS).otherwise(0.0)


def selection_reason(detections_low: Column) -> Column:
    """The first reasons that hold, joined by ';'."""
    found = F.array(F.when(detections_low == 0, ZERO_REASON), *(F.when(F.col(c) >= HIGH, r) for c, r in REASONS.items()))
    return F.coalesce(F.nullif(F.array_join(F.slice(F.array_compact(found), 1, MOST_REASONS), ";"), F.lit("")), F.lit(DEFAULT_REASON))


def detection_stats(detections: DataFrame, images: DataFrame, key: str, standard: float, small: float = 0.003) -> DataFrame:
    """Per image of `images`: counts, confidences and size shares of its detections (confidence, x1, y1, x2, y2).

    Images without detections (or without any of at least `standard` confidence) get 0, but 1 for
    the shares of low confidence and of small ones.
    """
    std = F.col("confidence") >= standard
    size = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    stats = detections.groupBy(key).agg(
        F.count(F.lit(1)).alias("detection_count_low"),
        F.count_if(std).alias("detection_count_standard"),
        F.avg(F.when(std, F.col("confidence"))).alias("confidence_mean"),
        F.median(F.when(std, F.col("confidence"))).alias("confidence_median"),
        F.avg((~std).cast("double")).alias("low_confidence_fraction"),
        F.avg(F.when(std, (size < small).cast("double"))).alias("small_face_fraction"),
        F.min(F.when(std, size)).alias("minimum_box_area_fraction"),
    )
    empty = {"detection_count_low": 0, "detection_count_standard": 0, "confidence_mean": 0.0, "confidence_median": 0.0, "low_confidence_fraction": 1.0, "small_face_fraction": 1.0, "minimum_box_area_fraction": 0.0}
    out = images.select(key).distinct().join(stats, key, "left")
    return out.select(key, *(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in empty.items()))


def uncertainty(confidence_mean: Column, low_confidence_fraction: Column) -> Column:
    """What a model is unsure of: 1 less the mean confidence, plus the share of low ones."""
    return 1 - confidence_mean + low_confidence_fraction


def capped_detections(detections: DataFrame, key: str, index: str, floor: float, most: int = 300) -> DataFrame:
    """The detections of at least `floor` confidence, `most` an image, surest first (ties: smaller index)."""
    best = Window.partitionBy(key).orderBy(F.desc("confidence"), index)
    rows = detections.where(F.col("confidence") >= floor).withColumn("place", F.row_number().over(best))
    return rows.where(F.col("place") <= most).drop("place")


def overlap_fraction(boxes: DataFrame, key: str, index: str, threshold: float = 0.05) -> DataFrame:
    """(key, crowding_iou_fraction): the share of box pairs with IoU of at least the threshold; 0 for under two boxes."""
    box = F.struct("x1", "y1", "x2", "y2")
    left = boxes.select(key, F.col(index).alias("i"), box.alias("a"))
    right = boxes.select(key, F.col(index).alias("j"), box.alias("b"))
    pairs = left.join(right, key).where("i < j").groupBy(key).agg(F.avg((box_iou(F.col("a"), F.col("b")) >= threshold).cast("double")).alias("f"))
    return boxes.select(key).distinct().join(pairs, key, "left").select(key, F.coalesce("f", F.lit(0.0)).alias("crowding_iou_fraction"))


#: Rows of a group that are streamed to the driver; a group that needs more is asked for again.
DEPTH = 8


def _far(sig: int, chosen: list[Row], threshold: int) -> bool:
    return all((sig ^ c["sig"]).bit_count() > threshold for c in chosen)


def _far_from(chosen: list[Row], threshold: int) -> Column:
    """As _far, for the column sig."""
    known = F.lit([c["sig"] for c in chosen]) if chosen else F.array().cast("array<long>")
    return F.forall(known, lambda s: F.bit_count(F.col("sig").bitwiseXOR(s)) > threshold)


def select_diverse(records: DataFrame, k: int, per_group: int, most_zero: int, threshold: int) -> list[Row]:
    """Greedy choice of k records (id, group, score, sig, zero), far from each other in Hamming distance.

    First each group's best (ties: largest id), by score; then the rest by score (ties: smallest
    group and id). Records without a signature take no part. In rounds: what the choice so far forbids is
    filtered by Spark, and the best of the rest are offered in blocks of about k; the first of a block is always
    chosen, so there are at most k rounds, and the driver holds a block.
    """
    rows = Scratch(records.sparkSession, "diverse").save(records.select("id", "group", "score", "sig", "zero").where("sig IS NOT NULL"), "records")
    best = rows.groupBy("group").agg(F.max_by(F.struct("id", "score", "sig", "zero"), F.struct("score", "id")).alias("x")).select("x.id", "group", "x.score", "x.sig", "x.zero")
    chosen: list[Row] = []
    groups: Counter = Counter()
    zeros, size = 0, max(64, 2 * k)

    def allowed(r: Row) -> bool:
        return groups[r["group"]] < per_group and not (r["zero"] and zeros >= most_zero) and _far(r["sig"], chosen, threshold)

    def still_allowed() -> Column:
        full = F.lit(False)
        for g, n in groups.items():
            full = full | F.col("group").eqNullSafe(F.lit(g)) if n >= per_group else full
        zero = F.coalesce("zero", F.lit(False)) if zeros >= most_zero else F.lit(False)
        return ~full & ~zero & _far_from(chosen, threshold) & ~F.col("id").isin([c["id"] for c in chosen])

    for offered in (best, rows):
        block = [None] * size
        while len(chosen) < k and len(block) == size:
            block = offered.where(still_allowed()).orderBy(F.desc("score"), "group", "id").limit(size).collect()
            for r in block:
                if len(chosen) < k and allowed(r) and all(c["id"] != r["id"] for c in chosen):
                    chosen.append(r)
                    groups[r["group"]] += 1
                    zeros += bool(r["zero"])
    return chosen


def adjusted_score(score: Column, count: Column, soft_limit: int, penalty: float) -> Column:
    """The score less a penalty for each detection beyond the soft limit."""
    return score - penalty * F.greatest(F.lit(0), count - soft_limit)


def scene_representatives(records: DataFrame, threshold: int) -> list[Row]:
    """One record (id, group, score, sig) of every group, none near another's; raises where a group has none left.

    Groups go by their best score (ties: name), records within by score (ties: smallest id); those without a
    signature take no part. The driver streams DEPTH rows of each group; where all of these are near what is
    chosen, Spark looks for the best of all the group's rows that is not.
    """
    rows = Scratch(records.sparkSession, "scenes").save(records.select("id", "group", "score", "sig").where("sig IS NOT NULL"), "records")
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("score"), "id"))
    heads = rows.withColumn("place", place).where(F.col("place") <= DEPTH).withColumn("top", F.max("score").over(Window.partitionBy("group")))
    chosen: list[Row] = []
    for _, block in groupby(heads.orderBy(F.desc("top"), "group", "place").toLocalIterator(), key=lambda r: r["group"]):
        head = list(block)
        found = next((r for r in head if _far(r["sig"], chosen, threshold)), None)
        if not found and len(head) == DEPTH:
            rest = rows.where(F.col("group").eqNullSafe(F.lit(head[0]["group"])) & _far_from(chosen, threshold))
            found = next(iter(rest.orderBy(F.desc("score"), "id").limit(1).collect()), None)
        if not found:
            raise ValueError(f"no representative left for group {head[0]['group']}")
        chosen.append(found)
    return chosen


def central_representatives(items: DataFrame, group: str, id_col: str, score: Column) -> DataFrame:
    """(group, id, score, size): each group's row of the smallest score, ties to the smallest id."""
    rows = items.select(F.col(group), F.col(id_col), score.alias("score"))
    best = rows.groupBy(group).agg(F.min_by(F.struct(id_col, "score"), F.struct("score", id_col)).alias("x"), F.count(F.lit(1)).alias("size"))
    return best.select(group, f"x.{id_col}", "x.score", "size")


def second_picks(items: DataFrame, firsts: DataFrame, group: str, id_col: str, sig: str, score: Column, most: int) -> DataFrame:
    """(group, id, size) of the pick farthest from the first in the largest groups, `most` at most.

    Ties of distance go to the smaller score, then to the larger id; groups by size, then name.
    """
    first_sig = firsts.select(group, F.col(id_col).alias("first"), "size").join(items.select(F.col(id_col).alias("first"), F.col(sig).alias("first_sig")), "first")
    rows = items.select(F.col(group), F.col(id_col), F.col(sig), score.alias("s")).join(first_sig, group).where(F.col(id_col) != F.col("first"))
    far = F.bit_count(F.col(sig).bitwiseXOR(F.col("first_sig")))
    best = rows.groupBy(group).agg(F.max_by(F.col(id_col), F.struct(far, -F.col("s"), F.col(id_col))).alias(id_col), F.first("size").alias("size"))
    return best.orderBy(F.desc("size"), group).limit(most)
