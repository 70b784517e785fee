"""Operations of a large-scale training-data pipeline (cleaning, scoring,
counting, packing, deduplication, decontamination, extraction).  Nothing else
in the library imports this subpackage."""
