"""Named queries; importing this package registers all of them."""

from . import tables  # noqa: F401
from . import spatial  # noqa: F401
from . import geometry  # noqa: F401
from . import looks  # noqa: F401
from . import checks  # noqa: F401
from . import io  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
