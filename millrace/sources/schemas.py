"""Tables of the corpus: columns and keys.  Fixed values: names and types that the data has."""

from __future__ import annotations

from pyspark.sql.types import StructType

TABLES: dict[str, tuple[str, list[str]]] = {
    "video_index": ("target_video_filename string, target_video_seq_id int, perspective_cam_id int, compressed_mov_url string, uncompressed_avi_url string, uncompressed_avi_mirror_1_url string, uncompressed_avi_mirror_2_url string", ["target_video_filename"]),
    "corpus": ("DocumentID int, Filename string, XML_B64 string, LEN int", ["DocumentID"]),
    "consultant": ("ASLConsultantID int, Name string, Age int, Gender string", ["ASLConsultantID"]),
    "document_consultant": ("DocumentID int, ASLConsultantID int, Filename string, ParticipantName string", ["DocumentID", "ASLConsultantID"]),
    "utterance": ("DocumentID int, ASLConsultantID int, UtteranceSequence int, StartTime int, EndTime int, Tokens string, Translation string", ["DocumentID", "ASLConsultantID", "UtteranceSequence"]),
    "video": ("DocumentID int, ASLConsultantID int, CameraPerspective int, TargetVideoFilename string", ["DocumentID", "ASLConsultantID", "CameraPerspective"]),
    "video_utterance": ("DocumentID int, ASLConsultantID int, CameraPerspective int, TargetVideoFilename string, UtteranceSequence int", ["DocumentID", "ASLConsultantID", "CameraPerspective", "TargetVideoFilename", "UtteranceSequence"]),
    "utterance_video": ("DocumentID int, ASLConsultantID int, TargetVideoFilename string, UtteranceSequence int, CameraPerspective int", ["DocumentID", "ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "CameraPerspective"]),
    "video_segment": ("DocumentID int, ASLConsultantID int, CameraPerspective int, TargetVideoFilename string, SegmentSequence int, SegmentVideoFilename string, URL string", ["DocumentID", "ASLConsultantID", "CameraPerspective", "TargetVideoFilename", "SegmentSequence"]),
    "video_frame": ("DocumentID int, ASLConsultantID int, CameraPerspective int, TargetVideoFilename string, FrameSequence int, FramePath string", ["DocumentID", "ASLConsultantID", "CameraPerspective", "TargetVideoFilename", "FrameSequence"]),
    "vocabulary": ("TokenID int, Token string", ["TokenID"]),
    "utterance_token": ("DocumentID int, ASLConsultantID int, UtteranceSequence int, TokenSequence int, StartTime int, EndTime int, TokenID int, Field string, FieldValue string", ["DocumentID", "ASLConsultantID", "UtteranceSequence", "TokenSequence"]),
    "utterance_token_frame": ("DocumentID int, ASLConsultantID int, CameraPerspective int, TargetVideoFilename string, UtteranceSequence int, TokenSequence int, FrameSequence int, TokenID int", ["DocumentID", "ASLConsultantID", "CameraPerspective", "TargetVideoFilename", "UtteranceSequence", "TokenSequence", "FrameSequence"]),
} | {
    name: ("TokenID int, CameraPerspective int, ASLConsultantID int, TargetVideoFilename string, UtteranceSequence int, TokenSequence int, FrameSequence int", ["TokenID", "CameraPerspective", "ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "TokenSequence"])
    for name in ("train_assoc", "val", "train")
} | {
    f"complete_utterances_{name}": ("ASLConsultantID int, TargetVideoFilename string, UtteranceSequence int, CameraPerspective int, StartTime int, EndTime int, TokenIDs string, Tokens string, Translation string", ["ASLConsultantID", "TargetVideoFilename", "UtteranceSequence", "CameraPerspective"])
    for name in ("train_assoc", "val", "train")
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name][0])


def key(name: str) -> list[str]:
    return list(TABLES[name][1])
