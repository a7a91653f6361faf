"""martlake — e-commerce sales analytics, cleaning, currency, quality,
history, text and streaming operators as Spark DataFrame functions."""

from martlake.session import build_session, configure, checkpoint_root, scratch_path

__all__ = ["build_session", "configure", "checkpoint_root", "scratch_path"]
