"""``python -m hazardpanel <job> ...`` runs the job entry points of ``hazardpanel.jobs``."""

from hazardpanel.jobs import main

if __name__ == "__main__":
    main()
