"""Part of lexiloom."""
