"""Training-data operators: cleaning, classifying, deduplicating, mixing, packing and encoding documents."""
