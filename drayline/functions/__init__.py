"""Column functions. Every one returns a ``Column`` built from JVM-side expressions."""

from drayline.functions.casting import *  # noqa: F401,F403
from drayline.functions.geo import *  # noqa: F401,F403
from drayline.functions.numeric import *  # noqa: F401,F403
from drayline.functions.temporal import *  # noqa: F401,F403
from drayline.functions.text import *  # noqa: F401,F403
