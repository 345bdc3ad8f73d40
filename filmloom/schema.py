"""Schemas of the tables, as DDL."""

_ACTOR = "struct<actor: string, display_name: string, similarity: double, similarity_margin: double, face_gender: string, bbox: array<int>, yolo_confidence: double>"

#: The central table: one row per state of a clip.
CLIP = (
    "video_id string, clip_id string, scene_id int, source_video string, timestamp_start double, timestamp_end double, duration double, phash string, crop_box string, "
    "keep boolean, dup_of string, unimatch_motion double, vmaf_motion double, motion_score double, motion_pass boolean, aesthetic_score double, technical_score double, dover_score double, "
    "s2_reject_reason string, band_removed boolean, has_text boolean, text_overlay struct<present: boolean, text_type: string, confidence: double, summary: string>, "
    "bucket string, bucket_confidence double, reject boolean, reject_reason string, attributes map<string, string>, verified boolean, bucket_verified boolean, confidence double, route string, actor_status string, "
    f"actors array<{_ACTOR}>, clip_actors array<string>, actors_f1 array<string>, actors_f2 array<string>, actors_f3 array<string>, pos_f1 string, pos_f2 string, pos_f3 string, "
    "actor_tag_min_similarity double, actor_tag_min_margin double, caption string, generated_caption string, caption_struct string, prompt_version string, clip_score double, icr double, aod double, "
    "final_score double, verdict string, caption_verify_score int, caption_verify_score_norm double, caption_verify_explanation string, caption_verify_pass boolean, "
    "processing_status map<string, boolean>, schema_version string, segment_time_offset_sec double"
)

REGISTRY = "video_id string, source_path string, status string"
MOVIE_LIST = "path string, source_type string"
SCORES = "image_path string, caption string, model string, bucket string, source_type string, clip_score double, aod_score double, noun_count int, icr_score double, combined_score double, gate string"
RUNTIME = "service string, movie string, status string, runtime_seconds double, stats map<string, string>"
ACTOR = "actor_name string, embedding array<float>, num_images_used int"

#: Columns of the caption export, in order.
EXPORT = "clip_id video_id source_video timestamp_start timestamp_end duration bucket caption clip_actors clip_score final_score verdict".split()
