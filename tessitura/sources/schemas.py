"""Schemas of every table of the engine, as DDL; sources never infer one."""

from __future__ import annotations

_INPUT = "struct<audio_url:string,audio_urls:array<string>,ext:string,language:string,language_candidates:array<string>,model_size:string,model_sizes:array<string>,cluster_threshold:double,num_speakers:int,diarization_mode:string,recording_id:string>"
JOB = f"id string, input {_INPUT}"
FILE = "recording_id string, file_idx int, filename string, duration_s double, creation_time_utc string, size_bytes bigint, format_name string"
SAMPLES = "recording_id string, block_idx int, first_sample bigint, samples array<float>"
LINE = "recording_id string, model string, line_idx int, timestamp_s double, timestamp_str string, text string"
SEGMENT_META = "recording_id string, model string, seg_idx int, start double, end double, no_speech_prob double, avg_logprob double, compression_ratio double, temperature double, text string"
INTERVAL = "recording_id string, seq bigint, start_s double, end_s double, local_speaker_id int"
FRAME_SCORES = "recording_id string, window_idx int, frame_idx int, scores array<float>"
FEATURES = "recording_id string, seq bigint, features array<array<float>>"
EMBEDDING = "recording_id string, seq bigint, embedding array<float>"
LABEL = "recording_id string, seq bigint, cluster int"
SEGMENT = "recording_id string, seg_idx int, start double, end double, speaker string"
DIARIZATION = "recording_id string, segments array<struct<start:double,end:double,speaker:string>>, num_speakers int, threshold double, model string, mode string"
LABELED_LINE = "recording_id string, model string, line_idx int, timestamp_s double, timestamp_str string, text string, speaker string, labeled string"
FLAGS = "recording_id string, model string, overall_detected_language string, overall_confidence double, window_flags array<struct<start_line:int,end_line:int,detected_language:string,confidence:double,flag:string>>, note string"
TIMING = "recording_id string, timing map<string,double>, diarization_provider string"
WORKER = "host string, gpus array<struct<name:string,memory_mb:string,driver_version:string,cuda_version:string>>"
PRICE = "gpu_name string, usd_per_hour double"
RUN_SUMMARY = "recording_id string, summary string"
RESPONSE = "recording_id string, models map<string,struct<transcript_lines:int,transcript:string,labeled_transcript:string>>, num_speakers int, audio_duration_s double, error string, detail string"
ARTIFACT = "recording_id string, filename string, content string"

TABLES = {"job": JOB, "file": FILE, "samples": SAMPLES, "line": LINE, "segment_meta": SEGMENT_META, "interval": INTERVAL, "frame_scores": FRAME_SCORES, "features": FEATURES, "embedding": EMBEDDING, "label": LABEL, "segment": SEGMENT, "diarization": DIARIZATION, "labeled_line": LABELED_LINE, "flags": FLAGS, "timing": TIMING, "worker": WORKER, "price": PRICE, "run_summary": RUN_SUMMARY, "response": RESPONSE, "artifact": ARTIFACT}
