"""Values that differ between runs, passed in so that a run can be repeated exactly."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime


@dataclass(frozen=True)
class RunContext:
    """Run date, batch id and clock of one job run."""

    run_date: str
    batch_job_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    now: datetime = field(default_factory=datetime.now)
    environment: str = "local"
    tags: tuple[str, ...] = ()

    @property
    def update_text(self) -> str:
        """Audit time as the text the sink stores."""
        return self.now.strftime("%Y-%m-%d %H:%M:%S")
