"""Exports, manifests, quarantine and stage checkpoints."""
