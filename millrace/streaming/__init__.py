"""The corpus jobs are batch jobs; this package has the one step that pays off on arriving files: keys."""
