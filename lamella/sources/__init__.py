"""Readers and writers for manifests, geometry, frames, voxels, points and parameter files."""
