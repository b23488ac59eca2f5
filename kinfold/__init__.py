"""Knowledge-graph consolidation as Spark DataFrame jobs."""

from kinfold.model import Graph
from kinfold.session import build_session, ensure_checkpoint_dir

__all__ = ["Graph", "build_session", "ensure_checkpoint_dir"]
