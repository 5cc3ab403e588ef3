"""Training-data operators: dedup, decontamination, tokens, quality, secrets, packing, sharding.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it exists.
"""
