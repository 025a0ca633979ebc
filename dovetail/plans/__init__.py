"""Table jobs. Importing a module registers its query keys."""
