"""idbridge: reconcile people records held in two systems under different ids.

Everything is a lazy DataFrame plan: readers in ``sources``, column
expressions in ``functions``, joins/checks/updates in ``operators`` and the
four reconciliation jobs in ``plans``.
"""

from idbridge.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
