"""shroud: Spark-native detection and redaction of sensitive information.

Every step is a DataFrame -> DataFrame transformation that runs the same way
on batch tables and on Structured Streaming input.  Findings live on the same
row as the text they come from (the "array plane"); an exploded findings table
(the "table plane") is used only where a join or a group-by needs it.
"""

from shroud.session import get_session, checkpoint_root  # noqa: F401

__all__ = ["get_session", "checkpoint_root"]
