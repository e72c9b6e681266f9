"""Jobs, and the queries that are registered."""

from loomwork.plans import stateful as stateful  # registers its queries
