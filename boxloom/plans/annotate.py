"""From the predictions of many models to one finished annotation per image."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import scale
from boxloom.functions import text as T
from boxloom.operators import affordances as aff
from boxloom.operators import assign, dedup, ground, merge, relate, scene, vote
from boxloom.operators.overlap import PAIR_LIMIT
from boxloom.sources import predictions

BOX = ["x1", "y1", "x2", "y2"]


@dataclass
class Level1:
    objects: DataFrame        # image_id, kind, id, box, labels, attributes, score
    affordances: DataFrame    # image_id, category, description, object_ids, labels
    crowded: bool             # some image has too many boxes for per-image plans


def level1(detections: DataFrame, words: DataFrame | None = None, models: DataFrame | None = None,
           keep: Callable[[DataFrame], DataFrame] = scale.checkpointed) -> Level1:
    """Suppress repeats, apply thresholds, let models vote, number objects, look up affordances.

    ``models``: a model table with registered models; ranks come from it when ``detections`` has none.

    Suppression, voting and numbering only ever see fewer boxes, so where no image holds many they need no count of
    their own.  ``keep`` stores the result: it feeds many later steps, and outside models read it."""
    if models is not None and "priority" not in detections.columns:
        detections = vote.with_priority(detections, models)
    crowded = scale.has_oversized(detections, ["image_id"], scale.GROUP_LIMIT)
    hot = None if crowded else False
    kept = vote.model_threshold(dedup.nms(scale.by_image(detections, crowded), hot=hot), models)
    voted = keep(vote.assign_ids(vote.vote(kept, models=models, hot=hot), hot=hot))
    words = aff.dictionary(detections.sparkSession) if words is None else words
    usable = aff.affordances(voted, words)   # before labels are generalised
    general = F.array_distinct(F.transform("labels", T.normalise_person))
    objects = voted.withColumn("labels", F.when(F.col("kind") == "object", general).otherwise(F.col("labels")))
    return Level1(objects.select("image_id", "kind", "id", *BOX, "labels", "attributes", "score"), usable, crowded)


@dataclass
class Level2:
    objects: DataFrame        # with label and, if depth was given, depth
    links: DataFrame          # image_id, seq, part, phrase, id, kind
    grounding: DataFrame      # image_id, pos, phrase, object_ids


def level2(first: Level1, images: DataFrame, phrases: DataFrame, described: DataFrame | None = None,
           crops: DataFrame | None = None, label_vectors: DataFrame | None = None, depth: DataFrame | None = None,
           keep: Callable[[DataFrame], DataFrame] = scale.checkpointed) -> Level2:
    """Reconcile phrases with objects, promote, add region descriptions, choose labels, measure depth.

    ``described(image_id, id, attribute)`` and ``crops(image_id, id, vector)`` come from models that saw the
    promoted objects.  Where no image holds many objects or phrase boxes, which is counted once, no step needs a count of its own."""
    hot = None if any(scale.has_oversized(df, ["image_id"], PAIR_LIMIT) for df in (first.objects, phrases)) else False
    objects, links = relate.promote(*relate.relate(first.objects, phrases, hot=hot), hot=hot)
    objects, links = keep(objects.drop("old_id")), keep(links)
    if described is not None:
        objects = relate.insert_attribute(objects, described)
    objects = relate.promote_big_boxes(objects, images)
    if crops is not None and label_vectors is not None:
        chosen = assign.assign_label(objects.where(F.col("kind") == "object"), crops, label_vectors)
    else:
        chosen = objects.select("image_id", "id", F.lit(None).cast("string").alias("label")).limit(0)
    objects = merge.choose_labels(objects, chosen)
    if depth is not None:
        objects = merge.add_depth(objects, depth, hot=hot)
    else:
        objects = objects.withColumn("depth", F.lit(None).cast("double"))
    return Level2(keep(objects), links, relate.grounding(links))


def scene_texts(second: Level2, images: DataFrame, captions: DataFrame, landmarks: DataFrame,
                hot: bool | None = None, most: int | None = 100) -> DataFrame:
    """The scene description of every image, input of the dense captioner.

    In images with more than ``most`` objects, those with attributes and the first others up to ``most`` are spoken of;
    None speaks of all."""
    if hot is None and not scale.has_oversized(second.objects, ["image_id"], scale.GROUP_LIMIT):
        hot = False
    layered = scene.depth_layers(scene.scene_objects(second.objects, most, hot))
    groups = scene.proximity_groups(layered, hot=hot)
    related = scene.relationship_groups(second.grounding, groups)
    base = relate.attach_captions(images.select("image_id"), captions).join(landmarks, "image_id", "left")
    return scene.scene_text(base, groups, related)


def finish(first: Level1, second: Level2, images: DataFrame, captions: DataFrame, landmarks: DataFrame,
           dense: DataFrame | None = None, masks: dict[str, DataFrame] | None = None,
           descriptions: DataFrame | None = None) -> DataFrame:
    """Ground the captions, add masks and context, and form one document per image.

    ``dense(image_id, caption)`` are the dense captions; ``masks`` the mask tables by source, preferred
    first; ``descriptions(class_name, description)`` the long class descriptions."""
    objects = second.objects
    short = captions.select("image_id", F.when(F.col("source") == "blip2", 0).otherwise(1).alias("caption_pos"), "caption")
    details = ground.ground_short(short, second.grounding, objects)
    extra = [ground.short_captions(short, details), landmarks, aff.as_map(first.affordances),
             relate.relationships(images, second.links).select(
                 "image_id", "part", F.struct("object_ids", "floating_object_ids", "grounding").alias("relationships"))]
    if dense is not None:
        found = ground.ground_dense(dense, objects, second.grounding)
        extra.append(ground.dense_captions(dense, found, objects))
    if masks:
        objects = merge.add_masks(objects, masks)
    base = merge.describe_classes(images, descriptions) if descriptions is not None else images
    return predictions.documents(base, objects, extra)
