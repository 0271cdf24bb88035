"""Part of helmtrack."""
