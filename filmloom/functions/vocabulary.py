"""Closed vocabularies (fixed values)."""

# The fifteen clip buckets; the first one is the fallback.
CLIP_BUCKETS = [
    "portrait_closeup",
    "two_shot",
    "group",
    "crowd",
    "song_dance",
    "action_fight",
    "interior_domestic",
    "street_urban",
    "rural_village",
    "religious_festival_ritual",
    "landscape_nature",
    "architecture_monument",
    "object_food_artifact",
    "text_poster_graphic",
    "intimate_suggestive",
]

# Clip buckets that people dominate.
PEOPLE_BUCKETS = [
    "portrait_closeup",
    "two_shot",
    "group",
    "crowd",
    "song_dance",
    "action_fight",
    "intimate_suggestive",
]

# Older labels and the clip buckets they stand for.
CLIP_ALIASES = {
    "people_portraits": "portrait_closeup",
    "portrait": "portrait_closeup",
    "closeup": "portrait_closeup",
    "bucket_01": "portrait_closeup",
    "clothing_textiles": "object_food_artifact",
    "bucket_02": "object_food_artifact",
    "architecture": "architecture_monument",
    "bucket_03": "architecture_monument",
    "bucket_04": "landscape_nature",
    "urban_street": "street_urban",
    "bucket_05": "street_urban",
    "bucket_06": "rural_village",
    "food_drink": "object_food_artifact",
    "bucket_07": "object_food_artifact",
    "festivals_rituals": "religious_festival_ritual",
    "bucket_08": "religious_festival_ritual",
    "objects_artifacts": "object_food_artifact",
    "bucket_09": "object_food_artifact",
    "bucket_10": "landscape_nature",
    "art_design": "text_poster_graphic",
    "bucket_11": "text_poster_graphic",
    "abstract_texture": "text_poster_graphic",
    "bucket_12": "text_poster_graphic",
}

# The twelve image buckets; the first one is the fallback.
IMAGE_BUCKETS = [
    "people_portraits",
    "clothing_textiles",
    "architecture",
    "landscape_nature",
    "urban_street",
    "rural_village",
    "food_drink",
    "festivals_rituals",
    "objects_artifacts",
    "animals_wildlife",
    "art_design",
    "abstract_texture",
]

# Other names of image buckets.
IMAGE_ALIASES = {
    "clothing_costume": "clothing_textiles",
    "architecture_built_environment": "architecture",
    "architecture_location": "architecture",
    "urban_street_life": "urban_street",
    "rural_village_life": "rural_village",
    "food_market": "food_drink",
    "festivals_rituals_events": "festivals_rituals",
    "festival_ritual": "festivals_rituals",
    "art_design_creative": "art_design",
    "abstract_texture_pattern": "abstract_texture",
    "everyday_life": "urban_street",
}

# Attributes that a classifier may add to a clip.
ATTRIBUTES = [
    "dominant_shot_scale",
    "dominant_people_count",
    "has_face",
    "has_text",
    "intimate_flag",
    "motion_type",
    "camera_movement",
    "scene_transition",
    "quality_issues",
    "tags",
    "era_hint",
    "dominant_actions",
    "temporal_consistency",
    "occlusion_level",
]

# Adjectives by category; of two categories the first one counts.
ADJECTIVES = {
    "color": "red blue green yellow orange purple pink brown black white grey gray golden silver beige crimson scarlet maroon turquoise teal ivory cream amber saffron copper bronze dark light bright pale deep vibrant vivid".split(),
    "size": "large small big tiny huge enormous little tall short wide narrow thick thin long miniature massive".split(),
    "texture": "smooth rough soft hard silky fuzzy bumpy coarse crispy crunchy flaky creamy glossy matte shiny glistening grainy powdery spongy chewy tender crusty".split(),
    "material": "wooden metal metallic glass ceramic plastic stone clay brass steel iron copper porcelain fabric leather bamboo terracotta".split(),
}

# Names of the image quality flags, in the order of their reasons.
QUALITY_FLAGS = ["blurry", "too_dark", "overexposed", "low_contrast", "text_heavy"]
