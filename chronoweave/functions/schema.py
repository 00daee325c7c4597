"""Schemas of the tables that operators exchange; times are integer milliseconds."""

from __future__ import annotations

RECORDINGS = "recording_id long, duration_ms long"
FRAMES = "recording_id long, frame_idx long, sumsq long, n long"
SILENCES = "recording_id long, start_ms long, end_ms long"
WINDOWS = "recording_id long, window_idx int, start_ms long, end_ms long"
WORDS = "recording_id long, model string, seq long, text string, start_ms long, end_ms long, window_idx int, center2_ms long"
TURNS = "recording_id long, turn_seq long, start_ms long, end_ms long, speaker string"
SEGMENTS = "recording_id long, model string, seg_seq long, start_ms long, end_ms long, speaker string, text string"
POLLS = "instance_id long, seq long, actual_status string, status_msg string, ssh_host string, ssh_port int, error string"
OFFERS = "id long, seq long, is_dc boolean, reliability2 double, inet_down double, dph_total double"
HYPOTHESIS = "timestamp struct<word: array<struct<word: string, start: double, end: double>>>"
CHECKPOINT = "abs_start double, abs_end double, text string, window_idx int, window_center double"
PROGRESS = "batch_idx int, chunks_done int, total_chunks int, batch_wall_sec double, cum_sec double, eta_sec double, words_so_far long"
