"""Fixed values of the domain: settings, corrections and patterns that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Settings and their defaults.


@dataclass(frozen=True)
class Settings:
    transcribe_batch_size: int = 16
    window_seconds: float = 30
    overlap_seconds: float = 20
    overlap_min_seconds: float = 5
    silence_anchor_tolerance_seconds: float = 3.0
    silence_threshold_db: float = -45.0
    silence_min_duration_ms: int = 200
    target_sample_rate: int = 16000
    speaker_smoothing_window_seconds: float = 2.0
    audit_edge_grace_seconds: float = 0.5
    audit_min_gap_seconds: float = 2.0
    coverage_min_pct: float = 95.0
    max_trailing_gap_seconds: float = 30.0
    frame_ms: int = 50
    most_windows: int = 10_000
    least_tail_seconds: float = 0.3
    inversion_band_seconds: float = 3.0
    preview_chars: int = 400
    mask_frame_ms: int = 30
    stuck_polls: int = 4


UNKNOWN_SPEAKER = "SPEAKER_UNKNOWN"

# Heard words and what they stand for, in the order they apply.
CORRECTIONS: dict[str, str] = {
    "Spearing": "Spiering",
    "Sperring": "Spiering",
    "Spring": "Spiering",
    "Ilastrin": "Elastrin",
    "Elastran": "Elastrin",
    "Alastrian": "Elastrin",
    "Elastin": "Elastrin",
    "Noran Vivare": "Vyavahare",
    "Narend Bevare": "Vyavahare",
    "Vihari": "Vyavahare",
    "Verhari": "Vyavahare",
    "Pafau": "Pfau",
    "Pafow": "Pfau",
    "Pafaus": "Pfau",
    "Bafau": "Pfau",
    "Pfaffel": "Pfau",
    "Dachisenko": "Daiichi Sankyo",
    "Dachi Senko": "Daiichi Sankyo",
    "enozyme": "Inozyme",
    "Ardana": "Ardena",
    "Ardenna": "Ardena",
    "Erdiana": "Ardena",
    "Nectaro": "Nectero",
    "ethrenate": "etidronate",
    "itranate": "etidronate",
    "hydrenate": "etidronate",
    "atindrene": "etidronate",
    "a vastin": "Avastin",
    "ILEA": "Eylea HD",
    "Iliya": "Eylea HD",
    "Lylea H D": "Eylea HD",
    "laposome": "liposome",
    "retonavir": "ritonavir",
    "retonovir": "ritonavir",
    "browse membrane": "Bruch's membrane",
    "Broux": "Bruch's",
    "brushes membrane": "Bruch's membrane",
    "corduroy artery": "choroidal artery",
    "corduid": "choroidal",
    "cortical artery": "choroidal artery",
    "supracordial": "suprachoroidal",
    "suprachordial": "suprachoroidal",
    "calcifylaxis": "calciphylaxis",
    "calcifica-laxis": "calciphylaxis",
    "morphon": "Marfan",
    "Barfan": "Marfan",
    "R Fond": "Marfan",
    "E N N T B": "ENPP1",
    "E N and T P": "ENPP1",
    "SNF four seventy two": "SNF472",
    "the destined platform": "ELT-101",
    "destin": "ELT-101",
    "dustin": "ELT-101",
}

# Patterns of text that no one said, in the order they are tried.
PATTERNS: list[str] = [
    r"(?i)thank you for watching",
    r"(?i)thanks for watching",
    r"(?i)subtitles by",
    r"(?i)subtitled by",
    r"(?i)amara\.org",
    r"(?i)\[music\]",
    r"(?i)\[applause\]",
    r"(?i)\[silence\]",
    r"(?i)please subscribe",
    r"(?i)like and subscribe",
    r"(?i)\[no audio\]",
    r"(?i)transcribed by",
]

# Names of the outputs of a run.
MODELS = ["canary", "parakeet"]
SHARED_SUFFIXES = [".diarization.json", ".coverage.json", ".warnings.json", ".semantic_inversions.json"]
MODEL_SUFFIXES = [".transcript.txt", ".srt", ".segments.json", ".hallucinations.json", ".final.txt", ".final.jsonl", ".speakers.json"]
DEBUG_SUFFIXES = [".canary.progress.log", ".parakeet.progress.log", ".canary.checkpoint.json", ".parakeet.checkpoint.json"]

# Prefixes that turn a word into its opposite.
OPPOSITES = {"hyper": "hypo", "hypo": "hyper"}
