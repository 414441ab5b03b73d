from wanderrank.functions.scalar import *  # noqa: F401,F403
from wanderrank.functions.scores import *  # noqa: F401,F403
