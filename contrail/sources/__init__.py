"""Raw schemas, the source registry, CSV / seed readers and the feed derived
from the generated tables."""
