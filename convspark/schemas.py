"""Declared schemas of the canonical tables."""

SEGMENT = "meeting_id string, start double, end double, speaker string, source string"
VAD_SEGMENT = "meeting_id string, start double, end double, label string, source string"
ASR_SEGMENT = "meeting_id string, start double, end double, speaker string, text string, confidence double, source string"
TOKEN = "meeting_id string, speaker_letter string, start double, end double, text string, is_punc boolean, seq bigint"
TURN = "meeting_id string, turn_idx int, start double, end double, speaker string, text_raw string, text_normalized string"
CHUNK = "meeting_id string, chunk_id string, turn_indices array<int>, start double, end double, text string"
DECISION = "meeting_id string, seq int, decision string, evidence_chunk_ids array<string>, evidence_snippets array<string>, confidence double, uncertain boolean"
ACTION = "meeting_id string, seq int, action string, owner string, due_date string, evidence_chunk_ids array<string>, evidence_snippets array<string>, confidence double, uncertain boolean"
TRACE = "meeting_id string, stage string, event string, status string, elapsed_sec double, ts_unix double, error string"
MANIFEST = "root string, meeting_id string, artifact_digest string, config_digest string"
RESPONSE = "meeting_id string, chunk_id string, task string, text string"
