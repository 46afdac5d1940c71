"""Text annotation and sentiment of posts, as Spark DataFrame operations."""

from tidemark.config import EngineConfig, session
from tidemark.jobs import run_batch, run_stream_job
from tidemark.plans.pipeline import Resources, annotate, build_pipeline

__all__ = ["EngineConfig", "Resources", "annotate", "build_pipeline", "run_batch", "run_stream_job", "session"]
