"""DataFrame operators: selection, geometry joins, voxel jobs, surfaces, registration and field algebra."""
