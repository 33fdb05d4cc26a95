"""simsift: similarity search and point-table builds as plain Spark DataFrame functions.

Every public function takes and returns DataFrames (usable with ``df.transform``).
No client object, no server: the work is expressed with the DataFrame API and
planned by Catalyst.
"""

__version__ = "0.1.0"

from simsift.session import get_session, checkpoint_dir  # noqa: F401
