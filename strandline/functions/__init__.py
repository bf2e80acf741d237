"""Column-level functions: safe casts, text, hashing, audio and vectors."""
