"""Spark jobs for sliced microscopy volumes: manifests, geometry, voxels, surfaces, fields and points."""
