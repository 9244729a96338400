"""Water-column profile analytics as Spark jobs."""

from fathomline.session import get_session
from fathomline.storage import save_stage, shared_dir

__all__ = ["get_session", "save_stage", "shared_dir"]
