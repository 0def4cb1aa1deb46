"""Running jobs: the part of the library that acts."""
