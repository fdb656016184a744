"""Prompts as expressions: a template is cut into literals and columns once, so values are never read as templates."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantic import predicate_block

_ROBOT = "The image is one sample for teaching a robot arm to handle things. It came with this caption: {original_caption}\n\n"
_SCENE = _ROBOT + "Detectors report this layout:\n\n{scene_graph}\n\n"

TYPE_A = _ROBOT + (
    "In one short paragraph, tell where everything in view is: name each object, whether it is left, centre or right and near or far, how the "
    "objects lie to each other, and rough distances. Leave robot actions out. State plain facts only."
)
TYPE_B = _ROBOT + (
    "Take the objects one by one. For each, give a sentence by which only that object can be meant, using place, depth, size and colour, then a "
    "sentence about the room around it. Answer in blocks of three lines:\nObject: <label>\nReferring: <sentence>\nFree space: <sentence>"
)
TYPE_C = _ROBOT + (
    "Speak for a robot arm that is about to act here. In a short paragraph, give the best side to grasp each object from, what stands in the way, "
    "and the clearest place to put something down."
)
TWO_CALL_GENERATE = _ROBOT + (
    "Brief the robot in one natural paragraph: what is where, near or far, left or right; how each object can be told from the others; where there "
    "is room and from which side to come."
)
VERIFY = "Compare the caption below with the image. Is any statement about places plainly wrong? Reply YES or NO and nothing else.\n\nCaption: {caption}"

SCENE_TYPE_A = _SCENE + (
    "Use the layout as a guide and the image as the judge. In one short paragraph, place every listed object, relate the objects to each other, and "
    "put right what the layout got wrong. Leave robot actions out."
)
SCENE_TYPE_B = _SCENE + (
    "For each listed object give a sentence by which only that object can be meant, and a sentence about the room around it that keeps or corrects "
    "the layout's hint. Answer in blocks of three lines:\nObject: <label>\nReferring: <sentence>\nFree space: <sentence>"
)
SCENE_TYPE_C = _SCENE + (
    "Speak for a robot arm that is about to act here. Using the depths and places above, give in a short paragraph the best side to grasp each "
    "object from, what stands in front of it, and where the layout leaves room to put something down."
)

SEMANTIC_EXTRACT = (
    "Read properties and relations off the image, guided by these detections:\n\n{scene_graph}\n\n"
    "In detail (boxes as x1,y1,x2,y2 in pixels, depth 0 nearest to 1 farthest):\n{scene_detections}\n\n"
    "Reply with one JSON object and nothing around it:\n"
    '{{"scene_context": {{"environment": str, "apparent_activity": str or null, "temporal_phase": "setup", "in_progress", "completed" or null, "confidence": "high" or "medium"}},\n'
    ' "objects": [{{"label": str, "position": str, "appearance": str or null, "appearance_confidence": "high" or "medium", "state": str or null, '
    '"state_confidence": "high" or "medium", "affordances": [from graspable, fillable, openable, stackable, pourable, cuttable, liftable]}}],\n'
    ' "relationships": [{{"subject": str, "predicate": str, "object": str, "type": str, "confidence": "high" or "medium", "evidence": str}}]}}\n\n'
    + predicate_block().replace("{", "{{").replace("}", "}}")
    + "\n\nOne entry in objects for each numbered line, with its label and position as printed; subjects are labels from the lines. "
    "Leave out what you are not sure of."
)
SEMANTIC_CAPTION = (
    "Write a caption for robot training.\n\nLayout, for your eyes only:\n{scene_graph}\n\nWhat is known of the objects:\n{semantic_annotation}\n\n"
    "One fluent paragraph, 80 to 150 words for up to four objects and 150 to 250 for more: where each object is, in everyday words; what it looks "
    "like; how it relates to the others where the image shows it. Say appears or likely where the confidence is medium. Nothing about mood, weight, "
    "motion or the future, and no word about detectors, ranks or boxes."
)
SEMANTIC_VERIFY = (
    "Compare the caption below with the image. Is any claim plainly wrong: a place, a look, a state, a relation, or something that one still image "
    "cannot show? Reply YES or NO and nothing else.\n\nCaption: {caption}"
)
SEMANTIC_VERIFY_OBJECT = (
    "This crop shows: {label}\nSo far its appearance is given as: {appearance}\nand its state as: {state}\n\n"
    "Check both against the crop alone and reply with one JSON object and nothing around it:\n"
    '{{"appearance": str or null, "appearance_confidence": "high" or "medium", "appearance_corrected": bool, '
    '"state": str or null, "state_confidence": "high" or "medium", "state_corrected": bool}}'
)


def filled(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by its column in one pass; doubled braces are braces; null values read None."""
    parts: list[Column] = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("None")))
    return F.concat(*parts)
